"""Intermediate tables that several passes read.

A staged table is written once to the shared checkpoint folder and read back as
parquet, so each later pass prunes columns and row groups, and a lost executor
costs a re-read instead of a re-run of the whole lineage. The shuffle files of a stage are
deleted once its table is written: later passes read the table, never the shuffle.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only for a local master without a setting."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files as they end; the setting is put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return the written table."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/staged/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(staged: DataFrame | None) -> None:
    """Delete a staged table that no later plan reads, through the file system of its path."""
    if staged is None:
        return
    files = staged.inputFiles()
    if not files:
        return
    spark = staged.sparkSession
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
