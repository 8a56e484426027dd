"""Shared folder for intermediate tables and streaming checkpoints.

A table that several jobs read is written once, as Parquet, to the folder named
by ``spark.checkpoint.dir``: readers prune columns, and losing an executor loses
nothing. Only a local session without that setting falls back to a temporary
folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="voltfleet-")


def work_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder nobody has used yet; it is not created."""
    return f"{work_folder(spark)}/voltfleet/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write the table once and continue from the written copy."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, on any file system Spark reads; none if there is no such folder."""
    system, folder = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    system, folder = _path(spark, path)
    system.delete(folder, True)
