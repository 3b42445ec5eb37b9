"""Folders that the driver and all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which a session on a cluster must name."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder, wherever that is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = hadoop_path(spark, path)
    return store.exists(at)


def first_folder(spark: SparkSession, path: str, prefix: str) -> str | None:
    """One of the folders in a folder whose names begin with ``prefix``."""
    store, at = hadoop_path(spark, f"{path}/{prefix}*")
    return next((f"{path}/{f.getPath().getName()}" for f in store.globStatus(at) or []), None)


def finished(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables in a folder that were written to their end, in order."""
    store, at = hadoop_path(spark, f"{path}/*/_SUCCESS")
    return sorted(f.getPath().getParent().getName() for f in store.globStatus(at) or [])
