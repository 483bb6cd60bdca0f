"""What JSON records hold, found out from the records themselves.

Records are parsed once into variants; their fields and types come from an aggregate that merges the
schemas of all values, so nothing is sampled and a type is what all rows agree on.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.operators.routing import record_type
from linepulse.registry import ROUTES, SPECS
from linepulse.sources.envelope import RECORD_LINEAGE


def variants(messages: DataFrame, routes: Mapping[str, str] = ROUTES, value: str = "value") -> DataFrame:
    """record_type, record (a variant) and raw; a text that is no JSON object has a NULL record."""
    both = F.struct(F.col(value).alias("raw"), F.try_parse_json(value).alias("record"))
    # exploded arrays of one: filters stay above them, so a record is parsed and its tag looked up once
    parsed = messages.select(F.explode(F.array(both)).alias("p")).select("p.raw", "p.record")
    tag = F.array(F.try_variant_get("record", "$.xml_tag_name", "string"))
    tagged = parsed.select("raw", "record", F.explode(tag).alias("tag"))
    return tagged.select(record_type(F.col("tag"), routes).alias("record_type"), "record", "raw")


def known_fields(routes: Mapping[str, str] = ROUTES) -> list[tuple[str, str]]:
    """(record_type, field) of all fields that the registry lands, names without case and marks."""
    lineage = [c.replace("_", "") for c in RECORD_LINEAGE]
    return [
        (name, key)
        for name in routes
        for key in {*(SPECS[name].field_key(c) for c in SPECS[name].columns), *lineage}
    ]


def fields(records: DataFrame, routes: Mapping[str, str] = ROUTES) -> DataFrame:
    """record_type, field, kind, row_count, nested, known for each field of each record type.

    `kind` is the merged type of all its values: BIGINT and DECIMAL widen, a field with texts and numbers
    is VARIANT, objects and arrays list what they hold (`nested`). `known` says whether the registry
    lands it; a new one would otherwise be dropped in silence. Values are pre-aggregated in every
    task, so a record type with most of the rows sends one row per field and task.
    """
    spark = records.sparkSession
    each = records.filter("record IS NOT NULL AND record_type IS NOT NULL").select("record_type", "record")
    pairs = each.lateralJoin(spark.tvf.variant_explode(F.col("record").outer())).select(
        "record_type", F.col("key").alias("field"), "value"
    )
    found = pairs.filter("field IS NOT NULL").groupBy("record_type", "field").agg(
        F.schema_of_variant_agg("value").alias("kind"), F.count("*").alias("row_count")
    )
    known = spark.createDataFrame(known_fields(routes), "record_type string, field_key string")
    key = F.lower(F.regexp_replace("field", "[^A-Za-z0-9]", ""))
    return (
        found.withColumn("field_key", key)
        .join(known.withColumn("landed", F.lit(True)), ["record_type", "field_key"], "left")
        .select(
            "record_type",
            "field",
            "kind",
            "row_count",
            F.col("kind").rlike("^(OBJECT|ARRAY)").alias("nested"),
            F.coalesce("landed", F.lit(False)).alias("known"),
        )
    )


def typed(records: DataFrame, table: str, paths: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Columns of one record type: name -> (path, type); a value that does not fit is NULL.

    Paths reach into nested objects and arrays, such as ``$.boards[0].serial``.
    """
    rows = records.filter(F.col("record_type") == table)
    return rows.select(
        *[F.try_variant_get("record", path, kind).alias(name) for name, (path, kind) in paths.items()]
    )
