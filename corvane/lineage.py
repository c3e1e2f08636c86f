"""Intermediate tables in the cluster's shared folder.

Iterative jobs cut their lineage by writing a table and reading it back: the rows are
computed once, survive the loss of any executor, and the next round plans from a scan.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing = threading.Lock(), {}  # by session: how many write now, and the setting before the first of them


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/corvane-{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write go when it ends. By itself Spark keeps them until the driver collects its garbage, so that
    those of many writes fill the disks of the executors."""
    with _lock:
        n, before = _writing.get(id(spark), (0, None))
        if not n:
            before = spark.conf.get(FREED, "false")
            spark.conf.set(FREED, "true")
        _writing[id(spark)] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _writing.pop(id(spark))
            if n > 1:
                _writing[id(spark)] = n - 1, before
            else:
                spark.conf.set(FREED, before)


def cut(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    With ``partition_by``, a later filter on that column reads only its folder.
    """
    path = fresh_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


class GrowingTable:
    """A table that a loop appends to, one folder per round."""

    def __init__(self, spark: SparkSession, name: str, schema) -> None:
        self._spark = spark
        self._schema = schema
        self._path = fresh_path(spark, name)
        self._rounds: list[str] = []

    def append(self, df: DataFrame) -> DataFrame:
        """Write one round and return it, read back."""
        folder = f"{self._path}/round={len(self._rounds)}"
        with freed_shuffles(self._spark):
            df.write.parquet(folder)
        self._rounds.append(folder)
        return self._spark.read.schema(self._schema).parquet(folder)

    def read(self) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(*self._rounds)
