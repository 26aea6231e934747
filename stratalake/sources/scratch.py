"""Shared scratch space for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="stratalake-")


def _files(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder;
    on a cluster such a folder would differ from machine to machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/stratalake/{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Used where a result feeds several passes: the files survive a lost executor,
    and their size is known when Spark picks a join strategy. The write's shuffle files go when it is done,
    the table when :func:`discard` is told so or the application ends.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark)
    path = f"{folder}/{name}"
    fs, at = _files(spark, folder)
    fs.deleteOnExit(at)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables that :func:`store` returned, once nothing reads them any more."""
    for df in stored:
        fs, at = _files(df.sparkSession, df.scratch_path)
        fs.delete(at.getParent(), True)
