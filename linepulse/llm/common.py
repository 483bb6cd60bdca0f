"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import pathlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.session import materialize

#: Characters that separate words in the contracts: space, tab, \n, \v, \f, \r.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a Java pattern.
SPACE_RUN = r"[\x20\x09-\x0D]+"

__all__ = [
    "SPACES",
    "SPACE_RUN",
    "ascii_lower",
    "map_batches",
    "materialize",
    "owned",
    "parts_for",
    "ship",
    "table",
    "text_or_empty",
    "with_rows",
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def with_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """`columns` and `row`, a number of its own for each row: doc_id where that is unique."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    repeated = ids.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not repeated:
        return docs.select(*columns, F.col("doc_id").cast("bigint").alias("row"))
    return materialize(docs.select(*columns, F.monotonically_increasing_id().alias("row")), "rows")


def owned(docs: DataFrame, columns: list[str] | None, results: tuple[str, ...]) -> tuple[list[str], Column]:
    """The caller's columns (all if none are named) and a struct of them, which no other column clashes with.

    Names that the result gives to its own columns are refused.
    """
    names = list(columns or docs.columns)
    taken = sorted({n for n in names if n.lower() in results})
    if taken:
        raise ValueError(f"columns {taken} have names of the result; rename them or name the columns to keep")
    return names, F.struct(*[F.col(f"`{n}`") for n in names])


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z and nothing else."""
    return text.translate(_LOWER)


_LOWER = {ord(c): ord(c.lower()) for c in _UPPER}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application (as --py-files does)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    to = pathlib.Path(tempfile.mkdtemp(prefix="linepulse-code-")) / "linepulse_code.zip"
    with zipfile.ZipFile(to, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(to))
    _shipped.add(context.applicationId)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(
    df: DataFrame, schema: str, work: Callable[[Iterator[dict]], Iterator[dict]], rows: int | None = None
) -> DataFrame:
    """`work` gets the batches of a partition as dicts of lists and yields dicts of columns.

    Batches hold a bounded number of rows and of bytes, so memory doesn't follow the partition. Where `work`
    treats each row by itself, smaller batches of at most `rows` take less memory as Python objects.
    """
    target = pa.schema(
        [(f.name, _ARROW[f.dataType.simpleString()]) for f in _struct(df.sparkSession, schema)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(b.to_pydict() for b in (batches if rows is None else _slices(batches, rows))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in target], schema=target
            )

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def _struct(spark: SparkSession, schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "float": pa.float32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def parts_for(n: int | float, each: int | float, least: int = 1) -> int:
    """How many groups of about `each` hold `n`."""
    return max(least, math.ceil(n / each))
