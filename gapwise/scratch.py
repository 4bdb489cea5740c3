"""Where intermediate tables go: the shared folder of the cluster, or a fresh one in tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a run within one process may go without."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="run-")


_folder: ContextVar[str | None] = ContextVar("scratch_folder", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other call gets, below the open scratch folder or else the root."""
    return f"{_folder.get() or scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """Collects the scratch of the enclosed calls and removes it at the end."""
    path = scratch_path(spark, label)
    before = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(before)
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    Cuts the lineage like a checkpoint, but stays columnar: later passes read only their columns,
    and a lost executor re-reads files instead of recomputing shuffles.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a materialized ``df`` that no plan reads any more, such as the table of
    an earlier round of an iteration."""
    files = df.inputFiles()
    if files:
        _remove(df.sparkSession, files[0].rsplit("/", 1)[0])
