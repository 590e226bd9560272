"""Folders for tables that a query writes and reads again: below spark.checkpoint.dir, which driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the session's shared folder. Only where none is set and all runs in one process (tests), below a private one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = spark.conf.get("spark.voxloom.tables", None)
        if root is None:
            root = f"file://{tempfile.mkdtemp(prefix='spark-voxloom-')}"
            spark.conf.set("spark.voxloom.tables", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """df written and read back, so that what reads it twice computes it once and a lost executor costs a read."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for any store that Spark reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, target = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []
