"""What a stream has read, given out, kept waiting and lost."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: One row for each source and batch of a query.
SOURCE_ROW = (
    "query string, batch_id bigint, source string, start_offset string, end_offset string, rows_in bigint"
)
_OBSERVED = "observed_rows"


def counted(stream: DataFrame, name: str = _OBSERVED) -> DataFrame:
    """The stream with a metric of its rows, which the progress of each batch reports."""
    return stream.observe(name, F.count(F.lit(1)).alias("n"))


def rows_in(query: StreamingQuery, name: str = _OBSERVED) -> int:
    """Rows that a query's batches have counted by ``counted`` since it started."""
    seen = [p.get("observedMetrics", {}).get(name) for p in map(_plain, query.recentProgress)]
    return sum(metric["n"] for metric in seen if metric is not None)


def _plain(progress) -> dict:
    return json.loads(progress.json) if hasattr(progress, "json") else progress


def dropped_groups(query: StreamingQuery) -> int:
    """State updates that came behind the watermark, added up over a query's batches.

    An aggregation counts them after its rows were added up in their tasks, so this tells that rows
    were late, not how many.
    """
    batches = map(_plain, query.recentProgress)
    return sum(
        s.get("numRowsDroppedByWatermark", 0) for p in batches for s in p.get("stateOperators", [])
    )


def source_rows(spark: SparkSession, name: str, *queries: StreamingQuery) -> DataFrame:
    """Positions of a query, from the progress of its runs: a row for each batch and source."""
    rows = [
        (name, p["batchId"], s["description"], _text(s.get("startOffset")), _text(s.get("endOffset")), s["numInputRows"])
        for query in queries
        for p in map(_plain, query.recentProgress)
        for s in p["sources"]
    ]
    return spark.createDataFrame(rows, SOURCE_ROW)


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset, sort_keys=True)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Key and value of what an operator of a query keeps, by the state data source."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint).select("key", "value")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query and the batches that they can be read as of."""
    return spark.read.format("state-metadata").load(checkpoint)


def waiting(spark: SparkSession, checkpoint: str, counter: int = 0, operator: int = 0) -> int:
    """Rows that wait in state, where the `counter`-th field of the value counts them."""
    rows = state_rows(spark, checkpoint, operator)
    fields = rows.schema["value"].dataType.fields
    names = ", ".join(f"f{k}: {f.dataType.simpleString()}" for k, f in enumerate(fields))
    value = F.col("value").cast(f"struct<{names}>")[f"f{counter}"]
    return rows.agg(F.coalesce(F.sum(value), F.lit(0))).first()[0]
