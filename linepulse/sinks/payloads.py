"""Rows to request bodies: JSON arrays of a bounded number of rows.

A payload table is the end of the pipe; whoever posts the bodies reads it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Service of each table whose landed rows are pushed.
SERVICES = {
    table: f"{table}_service"
    for table in (
        "ea_pap_slot",
        "ea_pap_timers",
        "ea_pap_info",
        "ea_pap_nozzle",
        "ea_progorderlist",
        "ea_ftdefects",
        "ea_wodetail",
        "ea_comptype",
        "ea_equipmentoutline",
    )
}
COST_SERVICE = "materialcost_service"

CHUNKS_PER_BUCKET = 64


def bucket_count(df: DataFrame, size: int) -> Column:
    """How many buckets keep a bucket near `CHUNKS_PER_BUCKET` payloads, from the row count."""
    rows = df.agg(F.count("*").alias("n"))
    return rows.select(F.ceil((F.col("n") + 1) / (size * CHUNKS_PER_BUCKET))).scalar()


def payloads(
    df: DataFrame,
    key: Sequence[str],
    size: int,
    body: Column | None = None,
    service: Column | str = "",
    bucket: Column | None = None,
    envelope: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Request bodies of at most `size` rows each.

    Rows are spread over buckets by the hash of `key`, which has to identify a row, and
    numbered in key order inside each bucket; a body never holds more than one bucket.
    `bucket` replaces the hash. `buckets` is their number; without it the rows are counted
    first. `envelope` puts the array into ``{"inputJson": [...]}``.
    """
    text = F.to_json(F.struct(*df.columns)) if body is None else body
    name = F.lit(service) if isinstance(service, str) else service
    if bucket is None:
        number = bucket_count(df, size) if buckets is None else F.lit(buckets).cast("bigint")
        bucket = F.pmod(F.xxhash64(*key), number)
    rows = df.select(
        name.alias("service"), bucket.alias("bucket"), *key, text.alias("body")
    )
    inside = W.partitionBy("service", "bucket").orderBy(*key)
    numbered = rows.withColumn("row_no", F.row_number().over(inside)).withColumn(
        "chunk", F.floor((F.col("row_no") - 1) / size)
    )
    items = F.sort_array(F.collect_list(F.struct("row_no", "body")))
    array = F.concat(F.lit("["), F.array_join(F.col("items")["body"], ","), F.lit("]"))
    if envelope:
        array = F.concat(F.lit('{"inputJson":'), array, F.lit("}"))
    return (
        numbered.groupBy("service", "bucket", "chunk")
        .agg(items.alias("items"), F.count("*").alias("row_count"))
        .select("service", "bucket", "chunk", "row_count", array.alias("payload"))
    )


def table_payloads(
    landed: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], size: int
) -> DataFrame:
    """Payloads of landed rows of several tables, each table for its own service."""
    union = None
    for table, df in landed.items():
        part = payloads(df, keys[table], size, service=SERVICES[table], envelope=True)
        union = part if union is None else union.unionByName(part)
    return union


def text_payloads(
    df: DataFrame,
    size: int,
    body: Column,
    service: Column | str = "",
    envelope: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Payloads of rows without a key; equal texts are all kept.

    Rows are spread by their text and their place in their task, so rows that are all alike still fill
    all buckets.
    """
    texts = df.select(body.alias("row_text"), F.monotonically_increasing_id().alias("place"))
    number = bucket_count(df, size) if buckets is None else F.lit(buckets).cast("bigint")
    bucket = F.pmod(F.xxhash64("row_text", "place"), number)
    return payloads(texts, ["row_text"], size, F.col("row_text"), service, bucket, envelope)
