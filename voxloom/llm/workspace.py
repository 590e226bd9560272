"""Intermediate tables in the folder that driver and executors share.

``spark.checkpoint.dir`` names that folder. Lineage is cut by writing Parquet there and reading it
back, so a lost executor costs a re-read and never a recomputation of the whole job.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_KEPT: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session; a private one only where none is configured and all runs in one process (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    own = spark.conf.get("spark.voxloom.scratch", None)
    if own is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = f"file://{tempfile.mkdtemp(prefix='spark-voxloom-')}"
        spark.conf.set("spark.voxloom.scratch", own)
        _KEPT.append((spark, own))
    return own


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _KEPT:
        if spark.sparkContext._jsc is not None and spark.sparkContext._jsc.sc().isStopped() is False:
            _delete(spark, path)


class Workspace:
    """Tables of one operator call. On leaving the block all are deleted but those made by keep()."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._temporary: list[str] = []

    def __enter__(self) -> Workspace:
        # every table is written once and read from then on, so its shuffle files can go with its execution
        self._before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        return self

    def __exit__(self, *error) -> None:
        self.spark.conf.set(CLEANUP, self._before)
        for path in self._temporary:
            _delete(self.spark, path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back; gone when the block ends."""
        path = f"{self.root}/{name}"
        self._temporary.append(path)
        return self._written(df, path)

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Write df and read it back; stays until the session ends."""
        path = f"{self.root}/{name}"
        _KEPT.append((self.spark, path))
        return self._written(df, path)

    def drop(self, name: str) -> None:
        path = f"{self.root}/{name}"
        self._temporary.remove(path)
        _delete(self.spark, path)

    def folder(self, name: str) -> str:
        """A folder for files that are no table; gone when the block ends."""
        path = f"{self.root}/{name}"
        self._temporary.append(path)
        return path

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        schema = df.schema
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema).parquet(path)
