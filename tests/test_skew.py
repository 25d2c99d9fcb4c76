"""The queries on tables where one store, and one user, hold a third of all rows."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.compare import TABLES, differences, duck, rows_of_duck, rows_of_spark


@pytest.fixture(scope="module")
def skewed(spark, tiny, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        if name not in ("lineitem", "events"):
            shutil.copy(f"{tiny}/{name}.parquet", folder / f"{name}.parquet")
    hot = {"lineitem": ("l_suppkey", "l_orderkey"), "events": ("user_id", "event_id")}
    for name, (key, spread) in hot.items():
        table = spark.read.parquet(f"{tiny}/{name}.parquet")
        moved = F.when(F.xxhash64(spread) % 3 == 0, F.lit(1)).otherwise(F.col(key)).cast("bigint")
        # One file, so that both engines read it under the same name.
        table.withColumn(key, moved).toPandas().to_parquet(
            folder / f"{name}.parquet", coerce_timestamps="us", allow_truncated_timestamps=True
        )
    return str(folder)


@pytest.fixture(scope="module")
def con(skewed):
    return duck(skewed)


def test_the_tables_are_skewed(spark, skewed):
    for name, key in (("lineitem", "l_suppkey"), ("events", "user_id")):
        table = spark.read.parquet(f"{skewed}/{name}.parquet")
        assert table.filter(F.col(key) == 1).count() > table.count() * 0.3


@pytest.mark.parametrize(
    "name",
    ["panel_daily", "rolling_columns", "split_by_time", "store_health", "adapted_predictions",
     "psi_features", "cusum_per_user", "cusum_stream", "forecast_features"],
)
def test_query_equals_sql_on_skewed_tables(spark, skewed, con, name):
    ours = rows_of_spark(driver.queries()[name](spark, skewed))
    assert differences(ours, rows_of_duck(con, driver.oracle_sql()[name])) == []
