"""Streams drained in several runs equal the batch result on the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.operators.cusum import cusum_series
from tallyloom.streaming import drain, read_stream, stream_cusum, stream_quality

START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    data = [(k, START + dt.timedelta(minutes=m), i, v) for k, m, i, v in rows]
    return spark.createDataFrame(data, "k string, ts timestamp, event_id long, e double").coalesce(1)


def run(spark, folder, parts, build):
    out = None
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        out = drain(build(read_stream(spark, f"{folder}/in", part.schema, 1)), f"{folder}/out", f"{folder}/check")
    return out


def test_state_continues_between_runs(spark, tmp_path):
    rows = [(k, m, m * 10 + n, float((m * 7 + n * 5) % 23 - 11)) for m in range(60) for n, k in enumerate("ab")]
    parts = [events(spark, rows[a:b][::-1]) for a, b in ((0, 50), (50, 90), (90, 120))]
    found = run(spark, str(tmp_path), parts, lambda s: stream_cusum(s, "k", "e"))
    batch = cusum_series(events(spark, rows), ["k"], ["ts", "event_id"], "e")
    columns = ["k", "event_id", F.round("cusum_pos", 6), F.round("cusum_neg", 6), "drift_detected", "direction"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
    assert found.filter("is_late").count() == 0


def test_late_rows_are_kept_and_marked(spark, tmp_path):
    parts = [
        events(spark, [("a", 10, 1, 9.0), ("a", 20, 2, 1.0)]),
        events(spark, [("a", 15, 3, 50.0), ("a", 30, 4, 1.0)]),
    ]
    found = run(spark, str(tmp_path), parts, lambda s: stream_cusum(s, "k", "e")).orderBy("event_id").collect()
    assert [r.is_late for r in found] == [False, False, True, False]
    assert [r.cusum_pos for r in found] == [6.0, 4.0, None, 2.0]
    assert found[2].direction is None and found[2].e == 50.0


def test_windows_close_with_the_watermark(spark, tmp_path):
    rows = [("a", m * 60, m, -1.0 if m % 5 == 0 else 2.0) for m in range(30)]
    parts = [events(spark, rows[:20]), events(spark, rows[20:])]
    found = run(spark, str(tmp_path), parts, lambda s: stream_quality(s, "k", "e")).collect()
    assert [(r.window_start, r.total_rows, r.missing_values, r.negative_values) for r in found] == [(START, 24, 0, 5)]
