"""Folders that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, removed when the session's Python ends.

    A local session without that setting gets one of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='terraops-')}"
        spark.sparkContext.setCheckpointDir(path)
    own = f"{path.rstrip('/')}/terraops-{uuid.uuid4().hex}"
    atexit.register(_drop, spark, own)
    return f"{own}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to a shared folder and read back: rows and what was computed for them no longer change."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """df dealt over all cores, for what takes long for each row: a small file is one task as it is read."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def rename_parts(spark: SparkSession, folder: str, name: str) -> None:
    """Gives the part files of a folder names of their own; name takes a number."""
    at, files = _files(spark, folder)
    found = sorted(str(f.getPath()) for f in files.listStatus(at) if f.getPath().getName().startswith("part-"))
    for k, path in enumerate(found):
        new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name.format(k)}")
        files.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), new)


def _drop(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jvm is None:
        return
    try:
        at, files = _files(spark, path)
        files.delete(at, True)
    except Exception as error:  # the session may be gone already
        print(f"left {path}: {type(error).__name__}")
