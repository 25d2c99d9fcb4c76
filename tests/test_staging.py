"""Staged tables leave nothing of their making behind."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tallyloom.sources.staging import SHUFFLE_CLEANUP, forget, stage


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_shuffle_of_a_stage_is_deleted_and_the_setting_put_back(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    staged = stage(rows, "summed")
    assert staged.agg(F.sum("s")).first()[0] == 499_500
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    # the check itself sums over one small exchange
    left = shuffle_files(spark) - before
    assert len({n.split("_")[1] for n in left}) <= 1


def test_forgotten_table_is_gone(spark):
    staged = stage(spark.range(5).toDF("a"), "short-lived")
    folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file:"))
    assert os.path.isdir(folder)
    forget(staged)
    assert not os.path.exists(folder)
    forget(None)
