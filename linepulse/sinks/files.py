"""Rows to tables and folders.

Batches of a stream go to a folder of their own below the table, named by the run and the batch
(``run=<run>/batch=<id>``). A run is a query with its checkpoint, so a batch that is run again
replaces its own rows, and neither another query nor a fresh checkpoint replaces any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.registry import KPI_PARTITIONS

BATCH = "batch"


def append_table(df: DataFrame, table: str) -> None:
    """Append by column name to a catalog table."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table)


def batch_key(batch_id: int | str) -> str:
    """The name of a batch that no batch of another run has."""
    run = getattr(batch_id, "run", None)
    return f"{run}-{int(batch_id)}" if run else str(batch_id)


def batch_folder(path: str, batch_id: int | None) -> str:
    if batch_id is None:
        return path
    run = getattr(batch_id, "run", None)
    return f"{path}/run={run}/{BATCH}={int(batch_id)}" if run else f"{path}/{BATCH}={batch_id}"


def written(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The rows of a batch, appended to a folder and read back for further products."""
    append_parquet(df, path, batch_id)
    return df.sparkSession.read.schema(df.schema).parquet(batch_folder(path, batch_id))


def append_parquet(
    df: DataFrame, path: str, batch_id: int | None = None, gather: bool = False
) -> None:
    """Append to a folder; `gather` moves the rows of many small tasks into few files."""
    mode = "append" if batch_id is None else "overwrite"
    rows = df.hint("rebalance") if gather else df
    rows.write.mode(mode).parquet(batch_folder(path, batch_id))


def append_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = KPI_PARTITIONS,
    batch_id: int | None = None,
) -> None:
    """Append in one folder per partition value.

    Rows are gathered by partition value first so that folders get few files; adaptive
    execution splits the gathered rows of a value that has too many for one task.
    """
    mode = "append" if batch_id is None else "overwrite"
    gathered = df.hint("rebalance", *by)
    gathered.write.mode(mode).partitionBy(*by).parquet(batch_folder(path, batch_id))


def append_topic(messages: DataFrame, path: str, topic: str, batch_id: int) -> None:
    """Append messages of one topic to its folder, laid out as by `append_partitioned` and written where they lie."""
    rows = messages.withColumn("topic", F.lit(topic))
    rows.write.mode("overwrite").partitionBy("topic").parquet(batch_folder(path, batch_id))


def archive(messages: DataFrame, path: str, batch_name: str, value: str = "value") -> None:
    """Untouched message texts of a batch in a folder named after it; its files are compressed.

    Messages repeat the names of their fields, so a file takes a small part of its text.
    """
    rows = messages.select(F.col(value).alias("value"))
    rows.write.mode("overwrite").option("compression", "gzip").text(f"{path}/{batch_name}")


def batch_name(prefix: str, batch_id: int | str) -> str:
    return f"{prefix}_{batch_id}"
