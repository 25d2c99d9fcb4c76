"""Rows without a key, a block or a date keep their place; values are shown as they are."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from tallyloom.operators.cusum import cusum_series, cusum_series_in_blocks
from tallyloom.operators.split import baseline_split, time_split
from tallyloom.plans.catalog import tidy
from tallyloom.streaming import drain_updates, read_stream, stream_quality


def test_block_series_keeps_rows_without_key_or_block(spark):
    df = spark.createDataFrame(
        [("a", 1, 4.0), ("a", None, 9.0), (None, 1, 5.0), (None, 2, 5.0)], "k string, t int, e double"
    )
    blocks = cusum_series_in_blocks(df, ["k"], ["t"], "e", F.col("t"))
    whole = cusum_series(df, ["k"], ["t"], "e")
    assert blocks.count() == 4
    assert sorted(map(str, blocks.collect())) == sorted(map(str, whole.select(blocks.columns).collect()))


def test_rows_without_date_are_the_latest(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 9)]
    rows = [(i, d) for i, d in enumerate([*days, None, None])]
    df = spark.createDataFrame(rows, "store_id long, date date")
    split = {r["store_id"]: r["split"] for r in time_split(df).collect()}
    assert [split[i] for i in range(10)] == ["train"] * 8 + ["val", "test"]
    assert {r["period"] for r in baseline_split(df).where("date is null").collect()} == {"current"}
    early = {r["store_id"]: r["split"] for r in time_split(df.where("store_id != 8")).collect()}
    assert early[9] == "test" and early[0] == "train"


def test_values_are_not_capped(spark):
    df = spark.createDataFrame(
        [(123456789.12, 1e13), (0.01, -2e15), (5.5, float("nan")), (7.25, 123456789.12), (1.0, -0.00001), (2.0, None)],
        "sales_amount double, total double",
    )
    rows = [tuple(r) for r in tidy(df).collect()]
    assert [r[0] for r in rows] == [123456789.12, 0.01, 5.5, 7.25, 1.0, 2.0]
    assert rows[0][1] == 1e13 and rows[1][1] == -2e15 and math.isnan(rows[2][1])
    assert math.isclose(rows[3][1], 123456789.12, rel_tol=1e-7) and rows[4][1] == 0 and rows[5][1] is None


def test_open_windows_and_late_rows(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(hours=h), 2.0) for h in (1, 5, 30, 60)]
    late = [("a", start + dt.timedelta(hours=2), 9.0), ("a", start + dt.timedelta(hours=61), 4.0)]
    out = dropped = None
    for part in (rows, late):
        spark.createDataFrame(part, "k string, ts timestamp, e double").write.mode("append").parquet(f"{tmp_path}/in")
        source = read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
        out, dropped = drain_updates(
            stream_quality(source, "k", "e"), f"{tmp_path}/out", f"{tmp_path}/check", ["window_start", "k"], "window_end"
        )
    found = sorted((r["window_start"].day, r["total_rows"], r["mean_value"], r["is_final"]) for r in out.collect())
    assert found == [(1, 2, 2.0, True), (2, 1, 2.0, True), (3, 2, 3.0, False)] and dropped == 1
