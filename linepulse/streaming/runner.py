"""Starting streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from linepulse.session import settings
from linepulse.sinks.files import append_parquet

# State on disk and not on the heap, in one store for both sides of a join, of which a batch writes its changes,
# without a look for the old row at each change, which only serves a count of rows in the progress;
# files in splits that stay small when a record is read, parsed and kept in memory; a task writes a file
# for each record type at once, without a sort; no generated method so long that the JVM never compiles it, as
# those of tables with many columns are; files that are packed closer than by Spark's default, as a batch is kept as
# messages, records, rows and messages again.
QUERY_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
}


# For a query that gives out nothing when its watermark moves on, such as an inner join: what is past leaves the
# state with the next rows, and no batch without rows goes through all of it before.
NO_EMPTY_BATCHES = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


class BatchId(int):
    """The number of a batch and the run it belongs to."""

    run: str

    def __new__(cls, number: int, run: str):
        made = super().__new__(cls, number)
        made.run = run
        return made


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a checkpoint belongs to; it is kept in the checkpoint."""
    path = f"{checkpoint.rstrip('/')}/run"
    try:
        written = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        written = None
    if written is not None:
        return written[0]
    run = uuid.uuid4().hex[:12]
    # a folder without its file is what a start that died has left
    spark.createDataFrame([(run,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return run


def start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
    more: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Run `each` on every micro-batch.

    `interval` is the time between batches; without it the query works through what is
    there and stops. The checkpoint holds the position: a query has its own, and a batch
    that did not finish is run again under the same id. `each` gets the id as a `BatchId`,
    so a query with a fresh checkpoint, which counts from zero again, writes elsewhere.
    `more` are settings of this query beside ``QUERY_SETTINGS``.
    """
    run = run_id(stream.sparkSession, checkpoint)
    writer = (
        stream.writeStream.foreachBatch(lambda batch, number: each(batch, BatchId(number, run)))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    return begin(writer, stream.sparkSession, interval, more)


def begin(
    writer: DataStreamWriter, spark: SparkSession, interval: str | None = None, more: Mapping[str, str] | None = None
) -> StreamingQuery:
    """Start a query, which keeps ``QUERY_SETTINGS`` and `more` for itself."""
    once = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    with settings(spark, QUERY_SETTINGS | dict(more or {})):
        return once.start()


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function that keeps each batch in a folder of its own."""
    return lambda batch, batch_id: append_parquet(batch, path, batch_id)
