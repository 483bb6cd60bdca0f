"""Batch relations: catalog tables, parquet folders, database queries, literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.functions import text
from linepulse.registry import LOCATION_PLANT, SPECS, XREF_SCHEMA, full_name, table_ddl


def catalog_table(spark: SparkSession, table: str, env: str = "") -> DataFrame:
    return spark.table(full_name(env, table))


def parquet_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A landed raw table, read with its fixed schema."""
    return spark.read.schema(SPECS[table].schema).parquet(f"{path}/{table}")


def database_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query on another database; its rows go to the executors, not to the driver.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` with
    ``dbtable`` in `options` to read it in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if "dbtable" not in options:
        reader = reader.option("query", query)
    return reader.options(**options).load()


def location_plant(spark: SparkSession) -> DataFrame:
    """The fixed cross-reference of locations and plants."""
    return spark.createDataFrame(list(LOCATION_PLANT), XREF_SCHEMA)


def xref(df: DataFrame) -> DataFrame:
    """A cross-reference table, locations in lower case."""
    return df.select(F.lower("location").alias("location"), "plant")


def material_cost(df: DataFrame) -> DataFrame:
    """Cost table with the leading zeros of the material number taken off."""
    return df.select(
        text.strip_leading_zeros(F.col("material")).alias("material"), "plant", "unit_cost"
    )


def create_tables(spark: SparkSession, env: str = "", location: str | None = None) -> list[str]:
    """Create the database and the raw tables that are missing; gives their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {full_name(env, '').rstrip('.')}")
    for spec in SPECS.values():
        spark.sql(table_ddl(spec, env, location))
    return [full_name(env, name) for name in SPECS]


def footer_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose counts, minima and maxima come from the footers of its files.

    The newer file source can do that; aggregates on such a table without filters read no column.
    """
    setting = "spark.sql.sources.useV1SourceList"
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    before = spark.conf.get(setting)
    spark.conf.set(setting, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before)


def bucketed_table(
    spark: SparkSession, rows: DataFrame, name: str, key: str, buckets: int, location: str
) -> DataFrame:
    """`rows` as a catalog table in sorted buckets of `key`, and that table.

    Joins and sums on the key read the buckets as they lie, without a shuffle, on either side with the
    same number of buckets. The rows are dealt by bucket before they are written, so a bucket is one
    file that needs no sort on reading.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    rows.repartition(buckets, key).write.insertInto(name)
    return spark.table(name)
