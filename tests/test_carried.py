"""CUSUM by micro-batch jobs with carried sums: equal to the batch form, late rows, replays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.operators.cusum import cusum_series
from tallyloom.streaming import read_stream
from tallyloom.streaming.carried import batch_step, drain_cusum

START = dt.datetime(2024, 1, 1)


def columns():
    return ["k", "event_id", F.round("cusum_pos", 6), F.round("cusum_neg", 6), "drift_detected", "direction", "is_late"]


def events(spark, rows):
    data = [(k, START + dt.timedelta(minutes=m), i, v) for k, m, i, v in rows]
    return spark.createDataFrame(data, "k string, ts timestamp, event_id long, e double").coalesce(1)


def run(spark, folder, parts, files_per_batch=1):
    out = None
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = read_stream(spark, f"{folder}/in", part.schema, files_per_batch)
        out = drain_cusum(stream, f"{folder}/cusum", f"{folder}/check", "k", "e", block=F.date_trunc("hour", "ts"))
    return out


def test_batches_continue_the_sums_of_a_hot_key(spark, tmp_path):
    # key "a" holds most rows and spans many hour blocks; a NULL key is a key of its own
    rows = [("a" if m % 5 else ("b" if m % 2 else None), m * 7, m, float((m * 13) % 29 - 14)) for m in range(400)]
    parts = [events(spark, rows[a:b][::-1]) for a, b in ((0, 130), (130, 260), (260, 400))]
    found = run(spark, str(tmp_path), parts)
    whole = cusum_series(events(spark, rows), ["k"], ["ts", "event_id"], "e").withColumn("is_late", F.lit(False))
    assert sorted(map(tuple, found.select(columns()).collect()), key=repr) == sorted(map(tuple, whole.select(columns()).collect()), key=repr)
    assert found.select("batch").distinct().count() == 3


def test_late_rows_are_kept_and_marked(spark, tmp_path):
    parts = [
        events(spark, [("a", 10, 1, 9.0), ("a", 20, 2, 1.0)]),
        events(spark, [("a", 15, 3, 50.0), ("a", 30, 4, 1.0), ("a", 20, 2, 7.0)]),
    ]
    found = run(spark, str(tmp_path), parts).orderBy("event_id", "is_late").collect()
    assert [(r.event_id, r.is_late) for r in found] == [(1, False), (2, False), (2, True), (3, True), (4, False)]
    assert [r.cusum_pos for r in found] == [6.0, 4.0, None, None, 2.0]
    assert found[3].direction is None and found[3].e == 50.0


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    first = events(spark, [("a", m, m, float(m % 7)) for m in range(20)])
    second = events(spark, [("a", 20 + m, 20 + m, float(m % 5 - 4)) for m in range(20)])
    step = batch_step(first, folder, "k", "e")
    step(first, 0)
    step(second, 1)
    once = sorted(map(tuple, spark.read.parquet(f"{folder}/out").select(columns()).collect()), key=repr)
    carried = sorted(map(tuple, spark.read.parquet(f"{folder}/carried/version=1").collect()), key=repr)
    step(second, 1)  # the same batch after a failure
    again = sorted(map(tuple, spark.read.parquet(f"{folder}/out").select(columns()).collect()), key=repr)
    assert again == once and len(once) == 40
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/carried/version=1").collect()), key=repr) == carried


def test_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "k string, ts timestamp, event_id long, e double")
    step = batch_step(empty, str(tmp_path), "k", "e")
    step(empty, 0)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 0
    assert spark.read.parquet(f"{tmp_path}/carried/version=0").count() == 0
