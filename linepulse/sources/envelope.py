"""XML envelopes to records.

A message is an ``ArrayOfLiveTextData`` with one node per block of lines. Each block says
the names, the types and the separator of its values, so a record keeps its values in
arrays and gets its columns when it is landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linepulse.functions import convert, text

_TAG_VALUE = T.StructType(
    [
        T.StructField("_VALUE", T.StringType()),
        T.StructField("_fieldnames", T.StringType()),
        T.StructField("_fieldtypes", T.StringType()),
        T.StructField("_separator", T.StringType()),
    ]
)
_NODE = T.StructType(
    [
        T.StructField("TagName", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("TagId", T.StringType()),
        T.StructField("TimeStamp", T.StringType()),
        T.StructField("TagValue", T.ArrayType(_TAG_VALUE)),
    ]
)
ENVELOPE = T.StructType(
    [
        T.StructField("_filename", T.StringType()),
        T.StructField("LiveTextData", T.ArrayType(_NODE)),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
_XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreSurroundingSpaces": "false",
}

# Separators are regular expressions. These are the ones known to compile: plain
# characters, escapes and simple character sets, each with an optional quantifier.
_SAFE_SEPARATOR = (
    r"^(?:(?:[^\\\[\](){}*+?]|\\[^A-Za-z0-9]|\\[tnrsSdDwW]|\[[^\\\[\]^&-]+\])[*+?]?)+$"
)

RECORD_LINEAGE = (
    "xml_status",
    "xml_tag_id",
    "bicoe_load_dttm",
    "file_timestamp",
    "hdfs_file_name",
    "file_name",
    "kafka_topic",
    "xml_tag_name",
)
MALFORMED = "malformed_xml"
BAD_SEPARATOR = "bad_separator"
BAD_FIELDS = "bad_fields"


def _described(node: Column) -> Column:
    """The last TagValue of a node that names its fields, NULL when there is none."""
    return F.try_element_at(
        F.filter(node["TagValue"], lambda v: v["_fieldnames"].isNotNull()), F.lit(-1)
    )


def _descriptions(nodes: Column) -> Column:
    """Field descriptions of all nodes; one without takes that of the nearest node before it."""
    start = F.struct(
        F.lit(None).cast(_TAG_VALUE).alias("last"), F.array().cast(T.ArrayType(_TAG_VALUE)).alias("all")
    )

    def step(state, node):
        last = F.coalesce(_described(node), state["last"])
        return F.struct(last.alias("last"), F.concat(state["all"], F.array(last)).alias("all"))

    return F.aggregate(nodes, start, step, lambda s: s["all"])


def _clean(line: Column, values: Column) -> Column:
    """Blank values stay as they are, others lose the white space around them.

    Lines without tabs and the like, which are nearly all, need no pattern per value, and those without any
    white space no look at a value.
    """
    plain = F.transform(values, lambda v: F.when(F.trim(v) == "", v).otherwise(F.trim(v)))
    odd = F.transform(values, lambda v: F.when(text.blank(v), v).otherwise(text.stripped(v)))
    return F.when(~line.rlike(r"\s"), values).when(line.rlike(r"[\t\r\n\f\x0B]"), odd).otherwise(plain)


def field_keys(names: Column) -> Column:
    """Keys of the fields, last field first: of two fields with one key the last counts."""
    return F.reverse(text.keys_of(names))


def _bad(name: Column, i: Column) -> Column:
    value, word = F.get("field_values", i), F.get("field_types", i)
    good = (
        F.when(value.isNull(), False)
        .when(word.isin("String", "string"), True)
        .when(F.trim(value) == "", True)
        .when(convert.converts(value, word), True)
        .otherwise(text.blank(value))
    )
    return F.when(~good, name)


def parse(
    messages: DataFrame,
    topic: str,
    batch_name: Column | str,
    load_time: Column | None = None,
    value: str = "value",
) -> DataFrame:
    """Records of all messages, one row per header block and per detail line.

    Columns: the eight lineage columns, ``field_names``, ``field_types``, ``field_keys``,
    ``field_values``, ``bad_fields`` (names whose value is missing or does not convert), ``reason`` (NULL for
    a good record), ``readable`` (it has values) and ``raw`` (the line, or the message when it is not XML).
    """
    load = load_time if load_time is not None else F.current_timestamp()
    name = F.lit(batch_name) if isinstance(batch_name, str) else batch_name
    both = F.struct(
        F.col(value).alias("raw_message"), F.from_xml(value, ENVELOPE, _XML_OPTIONS).alias("x")
    )
    # an exploded array of one: filters stay above it, so a message is parsed once
    envelope = messages.select(F.explode(F.array(both)).alias("m")).select("m.raw_message", "m.x")
    found = F.col("x.LiveTextData")
    described = F.zip_with(
        found,
        _descriptions(found),
        lambda node, about: F.struct(node.alias("node"), about.alias("about")),
    )
    corrupt = F.col("x._corrupt_record").isNotNull()
    nodes = envelope.select(
        F.when(corrupt, F.col("raw_message")).alias("raw_message"),
        F.coalesce("x._filename", F.lit("")).alias("file_name"),
        corrupt.alias("corrupt"),
        F.size(found).alias("count"),
        described.alias("described"),
    )
    # scalars first, so that an exploded node doesn't carry its whole message
    nodes = nodes.select(
        "raw_message",
        "file_name",
        "corrupt",
        "count",
        F.posexplode_outer("described").alias("position", "n"),
    ).select("*", "n.node", "n.about")
    content = F.array_join(
        F.transform("node.TagValue", lambda v: F.coalesce(v["_VALUE"], F.lit(""))), ""
    )
    blocks = nodes.select(
        "raw_message",
        "file_name",
        "corrupt",
        "node",
        "about",
        ((F.col("position") == 0) & (F.col("count") > 1)).alias("is_header"),
        F.coalesce(content, F.lit("")).alias("content"),
    ).select(
        "*",
        F.split("about._fieldnames", ",").alias("field_names"),
        F.split("about._fieldtypes", ",").alias("field_types"),
        F.col("about._fieldtypes").rlike(r"^[Ss]tring(,[Ss]tring)*+\z").alias("all_text"),
    ).withColumn("field_keys", field_keys(F.col("field_names")))
    lines = F.when(F.col("is_header"), F.array("content")).otherwise(
        F.filter(F.split("content", "\\r?\\n"), lambda line: ~text.blank(line))
    )
    rows = blocks.select(
        "*",
        F.explode(
            F.when(F.col("corrupt"), F.array("raw_message")).otherwise(lines)
        ).alias("raw"),
    )
    separator = F.col("about._separator")
    safe = separator.rlike(_SAFE_SEPARATOR)
    split = F.when(safe & ~F.col("corrupt"), F.split("raw", separator, -1))
    records = rows.select(
        "raw",
        "corrupt",
        safe.alias("safe"),
        "field_names",
        "field_types",
        "all_text",
        "field_keys",
        _clean(F.col("raw"), F.slice(split, F.lit(1), F.size("field_names"))).alias("field_values"),
        F.coalesce("node.Status", F.lit("")).alias("xml_status"),
        F.coalesce("node.TagId", F.lit("")).alias("xml_tag_id"),
        F.date_format(load, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("bicoe_load_dttm"),
        F.coalesce("node.TimeStamp", F.lit("")).alias("file_timestamp"),
        name.alias("hdfs_file_name"),
        "file_name",
        F.lit(topic).alias("kafka_topic"),
        F.coalesce("node.TagName", F.lit("")).alias("xml_tag_name"),
    )
    # a text that is there always converts, so records of texts need no look at each
    names = F.size("field_names")
    whole = F.col("all_text") & (F.size("field_types") >= names) & (F.size("field_values") >= names)
    checked = records.withColumn(
        "bad_fields",
        F.when(whole, F.array().cast("array<string>")).otherwise(
            F.filter(F.transform("field_names", _bad), lambda n: n.isNotNull())
        ),
    )
    readable = ~F.col("corrupt") & F.coalesce("safe", F.lit(False))
    reason = (
        F.when(F.col("corrupt"), MALFORMED)
        .when(~readable, BAD_SEPARATOR)
        .when(F.size("bad_fields") > 0, BAD_FIELDS)
    )
    return checked.select(
        *RECORD_LINEAGE,
        "field_names",
        "field_types",
        "field_keys",
        "field_values",
        "bad_fields",
        reason.alias("reason"),
        readable.alias("readable"),
        "raw",
    )


def records(parsed: DataFrame) -> DataFrame:
    """Rows that have values: records with a bad field keep their other fields."""
    return parsed.filter("readable")


def quarantine(parsed: DataFrame) -> DataFrame:
    """What could not be read in full, with the raw text."""
    return parsed.filter(F.col("reason").isNotNull()).select(
        *RECORD_LINEAGE, "reason", "bad_fields", "raw"
    )


def record_json(with_uuid: bool = False) -> Column:
    """A parsed record as one JSON object: lineage and the message's own fields, typed."""
    own = F.transform(
        "field_names",
        lambda n, i: F.concat(
            convert.json_string(n),
            F.lit(":"),
            convert.json_value(F.get("field_values", i), F.get("field_types", i)),
        ),
    )
    # records of texts with different names, which are many, are written as a whole and not field by field
    names, typed = F.size("field_names"), F.array(*(F.lit(w) for w in convert.TYPE_WORDS))
    texts = (
        (F.size("field_values") >= names)
        & (F.size("field_types") >= names)
        & ~F.arrays_overlap("field_types", typed)
        & (F.size(F.array_distinct("field_names")) == names)
    )
    whole = F.to_json(F.map_from_arrays("field_names", F.slice("field_values", F.lit(1), names)))
    fields = F.when(texts, _inside(whole)).otherwise(F.array_join(own, ","))
    lineage = _inside(F.to_json(F.struct(*(F.col(c) for c in RECORD_LINEAGE)), {"ignoreNullFields": "false"}))
    parts = [F.lit("{"), fields, F.lit(","), lineage]
    if with_uuid:
        parts += [F.lit(',"uuid":"'), record_id(), F.lit('"')]
    return F.concat(*parts, F.lit("}"))


def _inside(object_text: Column) -> Column:
    """The fields of an object's JSON text."""
    return object_text.substr(F.lit(2), F.length(object_text) - 2)


def record_id() -> Column:
    """Id of a record that is the same when its message is read again."""
    parts = [F.col(c) for c in ("file_name", "xml_tag_name", "xml_tag_id", "file_timestamp", "raw")]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
