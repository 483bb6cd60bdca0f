"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def line_session(app: str = "linepulse", master: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC time and adaptive execution; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of this machine.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="linepulse-")
    return _local_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "stage"):
    """Write `df` to the shared folder and read it back, which cuts its lineage.

    The files outlive any executor, and every later branch reads the same rows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that ``spread`` gives a task, about.
TASK_ROWS = 100_000


def spread(rows: DataFrame, each: int = TASK_ROWS) -> DataFrame:
    """`rows` in tasks of about `each` rows, for work that takes long on a row or makes it much longer.

    A table of few files or row groups has few tasks, however many rows they hold.
    """
    return rows.repartition(rows.count() // each + 1)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for a while. A streaming query keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below `path` whose write has come to its end; none if there is no `path`."""
    files, at = _file_system(spark, path)
    if not files.exists(at):
        return []
    jvm = spark._jvm.org.apache.hadoop.fs
    return sorted(
        s.getPath().getName()
        for s in files.listStatus(at)
        if s.isDirectory() and files.exists(jvm.Path(s.getPath(), "_SUCCESS"))
    )


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that was written here and that nothing reads any more."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def clean_shared(spark: SparkSession, hours: float, now: float | None = None) -> list[str]:
    """Deletes folders of ``fresh_path`` that nothing has written to for so many hours; gives their names.

    What `materialize` writes outlives its query, as later branches read it. A job that runs every now
    and then, with `hours` longer than any query takes, keeps the shared folder small.
    """
    files, at = _file_system(spark, shared_dir(spark))
    if not files.exists(at):
        return []
    oldest = ((time.time() if now is None else now) - hours * 3600) * 1000
    gone = [
        s.getPath()
        for s in files.listStatus(at)
        if s.isDirectory() and _FRESH.search(s.getPath().getName()) and s.getModificationTime() < oldest
    ]
    for path in gone:
        files.delete(path, True)
    return sorted(path.getName() for path in gone)


_FRESH = re.compile(r"-[0-9a-f]{32}$")
