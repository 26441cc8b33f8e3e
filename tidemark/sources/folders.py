"""Folders that the driver and all executors reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of path, and path in its form."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = file_system(spark, path)
    system.delete(where, True)


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Where none is named, a folder of this machine that goes with the application, but only
    if the executors are in this process, as in tests; otherwise it fails."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
        if not named:
            _goes_at_exit(spark, sc._jsc.sc().getCheckpointDir().get())
    return sc._jsc.sc().getCheckpointDir().get()


def _goes_at_exit(spark: SparkSession, path: str) -> None:
    system, where = file_system(spark, path)
    system.mkdirs(where)
    system.deleteOnExit(where)


def shared_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder in the shared checkpoint folder, which goes when the application ends."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _goes_at_exit(spark, path)
    return path
