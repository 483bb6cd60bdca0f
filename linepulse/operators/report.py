"""Reports on the state of tables and topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every table."""
    return _union(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def freshness(tables: Mapping[str, DataFrame], loaded: Mapping[str, Column | str]) -> DataFrame:
    """Latest load time of every table."""
    return _union(
        [
            df.agg(F.max(loaded[name]).alias("last_updated")).select(
                F.lit(name).alias("table_name"), "last_updated"
            )
            for name, df in tables.items()
        ]
    )


def file_freshness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Time of the newest file of every table read from files."""
    newest = F.col("_metadata.file_modification_time")
    return freshness(tables, dict.fromkeys(tables, newest))


def newest(df: DataFrame, by: str, count: int = 1) -> DataFrame:
    """The newest rows, ties in the order of the other columns."""
    others = [c for c in sorted(df.columns) if c != by]
    return df.orderBy(F.col(by).desc(), *others).limit(count)


def topic_progress(offsets: DataFrame) -> DataFrame:
    """Messages of every topic: the latest offset of each partition, added up."""
    return (
        offsets.groupBy("topic", "partition")
        .agg(F.max("offset").alias("offset"))
        .groupBy("topic")
        .agg(F.sum("offset").alias("messages"))
    )
