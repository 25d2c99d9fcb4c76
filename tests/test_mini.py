"""Small hand-made frames whose results follow from the definitions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.calendar import calendar_features
from tallyloom.functions.rules import health_class, mape_action, mape_severity, recommended_action
from tallyloom.operators import cusum, drift, quality
from tallyloom.operators.adapter import apply_adapters, compare_models, fit_adapters
from tallyloom.operators.encode import encode_labels, label_codes
from tallyloom.operators.forecast import prediction_intervals
from tallyloom.operators.health import critical_stores, health_counts, store_health
from tallyloom.operators.impute import impute_group_mean
from tallyloom.operators.joins import attach, lookup_or
from tallyloom.operators.model import cluster_stats
from tallyloom.operators.panel import densify
from tallyloom.operators.psi import feature_psi
from tallyloom.operators.split import cut_rows, time_split
from tallyloom.operators.windows import (
    calendar_window_features,
    lag_features,
    rolling_mape,
    window_features,
)
from tallyloom.settings import ModelSettings


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_single_row_store_has_no_lags_and_no_deviation(spark):
    df = spark.createDataFrame([("a", day(0), 5.0)], "store_id string, date date, sales_amount double")
    row = only(window_features(df))
    assert row.sales_amount_lag_7d is None and row.sales_amount_rolling_std_7d is None
    assert row.sales_amount_rolling_mean_7d == row.sales_amount_rolling_max_30d == row.sales_amount_rolling_min_14d == 5.0


def test_row_lags_and_calendar_lags_differ_with_gaps(spark):
    days = [0, 1, 2, 3, 4, 5, 6, 14, 15]
    df = spark.createDataFrame(
        [("a", day(d), float(d)) for d in days], "store_id string, date date, sales_amount double"
    )
    rows = {r.date: r for r in lag_features(df, lags=[7]).collect()}
    assert rows[day(14)].sales_amount_lag_7d == 0.0  # seven rows back
    assert rows[day(15)].sales_amount_lag_7d == 1.0
    cal = {r.date: r for r in calendar_window_features(df, lags=[7], windows=[7]).collect()}
    assert cal[day(14)].sales_amount_lag_7d == 0.0  # no row on that date
    assert cal[day(6)].sales_amount_rolling_mean_7d == 2.5  # the day itself is left out
    assert cal[day(14)].sales_amount_rolling_mean_7d == 0.0  # empty window
    assert cal[day(15)].sales_amount_rolling_std_7d is None  # a single row


def test_imputation_by_brand_then_zero(spark):
    df = spark.createDataFrame(
        [("x", 1.0, 1), ("x", None, None), (None, None, 1)], "brand_id string, a_lag double, promotion_flag int"
    )
    rows = impute_group_mean(df, ["a_lag", "promotion_flag"]).collect()
    assert sorted((r.brand_id or "", r.a_lag, r.promotion_flag) for r in rows) == [
        ("", 0.0, 1.0),
        ("x", 1.0, 1.0),
        ("x", 1.0, 1.0),
    ]


def test_imputation_can_be_fitted_on_a_part(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 9.0), ("x", None)], "brand_id string, lag double")
    filled = impute_group_mean(df, ["lag"], fit_on=df.filter("lag < 5")).collect()
    assert sorted(r.lag for r in filled) == [1.0, 1.0, 9.0]


def test_calendar(spark):
    days = [dt.date(2023, 11, 24), dt.date(2023, 11, 25), dt.date(2023, 11, 26), dt.date(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    rows = {r.date: r for r in calendar_features(df).collect()}
    assert [rows[d].days_to_black_friday for d in days[:3]] == [1, 0, 365]
    monday = rows[days[3]]
    assert (monday.day_of_week, monday.week_of_year, monday.is_weekend, monday.days_to_new_year) == (0, 1, 0, 0)


def test_rolling_error_skips_zero_actuals(spark):
    df = spark.createDataFrame(
        [("a", day(i), y, p) for i, (y, p) in enumerate([(10.0, 11.0), (0.0, 5.0), (20.0, 10.0)])],
        "store_id string, date date, sales_amount double, prediction double",
    )
    rows = rolling_mape(df, window=2).orderBy("date").collect()
    assert [r.rolling_mape for r in rows] == pytest.approx([10.0, 10.0, 50.0])


def psi_of(spark, expected, actual, **options):
    rows = [(True, v) for v in expected] + [(False, v) for v in actual]
    df = spark.createDataFrame(rows, "base boolean, x double")
    return only(feature_psi(df, ["x"], F.col("base"), **options)).psi


def test_psi_edges(spark):
    steps = [float(i) for i in range(100)]
    assert psi_of(spark, steps, [1000.0 + v for v in steps]) == pytest.approx(4.559118386118215, abs=1e-12)
    assert psi_of(spark, [*steps, None], [v / 2 for v in steps]) == 0.0
    assert psi_of(spark, [*steps, None], [v / 2 for v in steps], null_policy="ignore") > 0.25
    assert psi_of(spark, [7.0] * 50, steps) == 0.0


def test_cusum_steps(spark):
    rows = [("a", i, e) for i, e in enumerate([4.0, 4.0, -10.0])]
    df = spark.createDataFrame(rows, "k string, i int, e double")
    out = cusum.cusum_series(df, ["k"], ["i"], "e").orderBy("i").collect()
    assert [r.cusum_pos for r in out] == pytest.approx([1.0, 2.0, 0.0])
    assert [r.cusum_neg for r in out] == pytest.approx([0.0, 0.0, -7.0])
    assert [r.drift_detected for r in out] == [False, False, True]
    assert [r.direction for r in out] == ["positive", "positive", "negative"]


def test_split_positions_of_a_large_table(spark):
    """Cuts at 332,960 and 374,580 of 416,201 rows leave 41,621 rows for the test part."""
    stores = 523
    df = spark.range(416201).select(
        F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("id") / stores).cast("int")).alias("date"),
        F.format_string("S%04d", F.pmod(F.col("id") * 7919, F.lit(stores))).alias("store_id"),
        F.col("id"),
    )
    counts = {r.split: r["count"] for r in time_split(df).groupBy("split").count().collect()}
    assert counts == {"train": 332960, "val": 41620, "test": 41621}


def test_split_follows_date_then_store(spark):
    df = spark.createDataFrame(
        [(day(i // 4), f"s{i % 4}", i) for i in range(20)], "date date, store_id string, i int"
    ).repartition(5)
    rows = time_split(df).collect()
    assert all(r.split == ("train" if r.i < 16 else "val" if r.i < 18 else "test") for r in rows)
    assert cut_rows(df, [1.0]).count() == 0


def test_adapter_shrinkage_and_clip(spark):
    adapters = spark.createDataFrame(
        [("a", 100.0, 219), ("b", -1000.0, 219)], "store_id string, mean_residual double, data_points long"
    )
    df = spark.createDataFrame([("a", 50.0), ("b", 50.0), ("c", 50.0)], "store_id string, prediction double")
    rows = {r.store_id: r for r in apply_adapters(df, adapters).collect()}
    assert rows["a"].adapted_prediction == pytest.approx(64.0)
    assert rows["b"].adapted_prediction == 0.0
    assert (rows["c"].adapted_prediction, rows["c"].prediction_type) == (50.0, "global_only")


def test_adapters_need_enough_rows(spark):
    df = spark.createDataFrame(
        [("a", 3.0, 1.0)] * 3 + [("b", 3.0, 1.0)] * 2, "store_id string, sales_amount double, prediction double"
    )
    row = only(fit_adapters(df, ModelSettings(min_adapter_rows=3)))
    assert (row.store_id, row.mean_residual, row.std_residual, row.data_points) == ("a", 2.0, 0.0, 3)


def test_model_comparison_counts(spark):
    df = spark.createDataFrame(
        [(10.0, 11.0, 10.0), (0.0, 5.0, 5.0), (20.0, 10.0, 20.0)],
        "sales_amount double, prediction double, adapted_prediction double",
    )
    row = only(compare_models(df))
    assert (row.total_samples, row.valid_samples, row.zero_sales_samples) == (3, 2, 1)
    assert row.global_mape == pytest.approx(30.0) and row.mape_reduction == pytest.approx(30.0)
    assert row.global_rmse == pytest.approx((101 / 2) ** 0.5)


def test_health_needs_enough_rows(spark):
    rows = [("six", 10.0)] * 6 + [("two", 10.0)] * 2 + [("two", 0.5)] * 5 + [("ok", 10.0)] * 3 + [("ok", 1.0)] * 4
    df = spark.createDataFrame([(s, y, 10.4) for s, y in rows], "store_id string, sales_amount double, prediction double")
    health = store_health(df)
    row = only(health)
    assert (row.store_id, row.num_days, row.health_status) == ("ok", 3, "healthy")
    assert row.mape == pytest.approx(4.0)
    assert [(r.health_status, r.stores, r.percentage) for r in health_counts(health).orderBy("position").collect()] == [
        ("healthy", 1, 100.0), ("warning", 0, 0.0), ("critical", 0, 0.0)
    ]
    empty = health_counts(health.filter("mape < 0")).collect()
    assert [r.percentage for r in empty] == [0.0, 0.0, 0.0]


@pytest.mark.parametrize(
    ("current", "baseline", "severity", "action"),
    [
        (4.99, 4.99, "none", "none"),
        (5.0, 5.0, "minor", "alert_only"),
        (8.0, 8.0, "moderate", "retrain_cluster"),
        (12.0, 12.0, "severe", "retrain_global_emergency"),
        (4.0, 3.0, "minor", "alert_only"),
        (4.0, 0.0, "none", "none"),
    ],
)
def test_mape_severity(spark, current, baseline, severity, action):
    found = mape_severity(F.lit(current), F.lit(baseline))
    row = only(spark.range(1).select(found.alias("s"), mape_action(found).alias("a")))
    assert (row.s, row.a) == (severity, action)


@pytest.mark.parametrize(
    ("severity", "features", "gradual", "any_drift", "action"),
    [
        ("severe", 9, True, True, "retrain_global_emergency"),
        ("moderate", 0, True, True, "retrain_cluster"),
        ("none", 5, True, True, "retrain_cluster"),
        ("minor", 4, True, True, "investigate_gradual_drift"),
        ("minor", 4, False, True, "alert_only"),
        ("none", 0, False, False, "none"),
    ],
)
def test_action_precedence(spark, severity, features, gradual, any_drift, action):
    chosen = recommended_action(F.lit(severity), F.lit(features), F.lit(gradual), F.lit(any_drift))
    assert only(spark.range(1).select(chosen.alias("a"))).a == action


def test_drift_fallback_and_report(spark):
    df = spark.createDataFrame(
        [(True, 0.5, 9.0), (False, 10.0, 4.0)], "base boolean, sales_amount double, prediction double"
    )
    errors = drift.error_summary(df, F.col("base"))
    row = only(errors)
    assert (row.current_mape, row.baseline_mape, row.mean_residual) == (999.0, 999.0, 6.0)
    psi = spark.createDataFrame(
        [("x", 0.3, True, "high"), ("y", 0.0, False, "low")],
        "feature string, psi double, drift_detected boolean, severity string",
    )
    report = only(drift.drift_report(errors, psi))
    assert report.psi.drifted_features == 1 and report.psi.details["x"].severity == "high"
    assert (report.cusum.cusum_pos, report.cusum.direction) == (3.0, "positive")
    assert report.recommended_action == "retrain_global_emergency"


def advice(spark, action, drifted, critical):
    report = spark.createDataFrame(
        [(action, (drifted,))], "recommended_action string, psi struct<drifted_features: bigint>"
    )
    health = spark.createDataFrame(
        [(f"S{i:02d}", 100.0 - i, "critical") for i in range(critical)] + [("H", 1.0, "healthy")],
        "store_id string, mape double, health_status string",
    )
    return [r.recommendation for r in drift.recommendations(report, health).orderBy("position").collect()]


def test_recommendations(spark):
    assert advice(spark, "retrain_cluster", 8, 12) == [
        "Retrain models for affected store cluster (12 stores)",
        "Focus on stores: S00, S01, S02, S03, S04 and others",
        "Feature drift detected in 8 features. Review data pipeline for quality issues.",
        "12 stores in critical state. Consider cluster-level intervention.",
    ]
    assert advice(spark, "retrain_cluster", 2, 2)[1:] == ["Focus on stores: S00, S01"]
    assert len(advice(spark, "retrain_global_emergency", 0, 0)) == 2
    assert advice(spark, "none", 0, 0) == ["No action required. Models performing within expected ranges."]
    assert advice(spark, "alert_only", 0, 10)[0].startswith("Continue monitoring")
    assert advice(spark, "investigate_gradual_drift", 0, 0)[0].startswith("Investigate gradual drift")


def test_critical_stores_are_ordered_and_limited(spark):
    rows = [(i, float(i), "critical" if i > 2 else "healthy") for i in range(12)]
    df = spark.createDataFrame(rows, "store_id long, mape double, health_status string")
    assert [r.store_id for r in critical_stores(df).collect()] == [11, 10, 9, 8, 7]
    assert critical_stores(df, None).count() == 9


def test_interval_width(spark):
    df = spark.createDataFrame([(0.0,), (100.0,)], "predicted_sales double")
    rows = prediction_intervals(df).orderBy("predicted_sales").collect()
    assert [(r.lower_bound, r.upper_bound) for r in rows] == [
        (0.0, pytest.approx(19.2)),
        (pytest.approx(80.8), pytest.approx(119.2)),
    ]


def test_label_codes_put_missing_text_in_order(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("z",)], "c string")
    rows = encode_labels(df, label_codes(df, ["c"]), ["c"]).collect()
    assert {r.c: r.c_encoded for r in rows} == {"a": 0, "b": 1, None: 2, "z": 3}


def test_outliers(spark):
    df = spark.createDataFrame([(5.0,)] * 5, "x double")
    assert not any(r.is_outlier for r in quality.flag_outliers(df, "x").collect())
    df = spark.createDataFrame([(1.0,)] * 30 + [(None,), (100.0,)], "x double")
    assert [r.x for r in quality.flag_outliers(df, "x").filter("is_outlier").collect()] == [100.0]


def test_quality_profile(spark):
    df = spark.createDataFrame(
        [(1, -1.0), (1, -1.0), (1, -1.0), (2, float("nan")), (None, 3.0)], "k int, sales_amount double"
    )
    found = {(r.check, r.column_name): r.result for r in quality.quality_profile(df).collect()}
    assert found == {
        ("total_rows", None): 5,
        ("missing_values", "k"): 1,
        ("missing_values", "sales_amount"): 1,
        ("negative_sales", "sales_amount"): 3,
        ("duplicates", None): 2,
    }
    assert quality.missing_columns(df, ["k", "z", "a"]) == ["a", "z"]
    assert [(r.column_name, r.data_type) for r in quality.column_types(df).collect()] == [
        ("k", "int"), ("sales_amount", "double")
    ]


def test_left_joins(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v int")
    dim = spark.createDataFrame([("a", 10), (None, 20), ("a", 11)], "k string, w int")
    assert sorted((r.v, r.w) for r in attach(fact, dim, ["k"]).fillna(0).collect()) == [(1, 10), (1, 11), (2, 0), (3, 0)]
    safe = attach(fact, dim, ["k"], null_safe=True)
    assert safe.columns == ["k", "v", "w"]
    assert sorted((r.v, r.w or 0) for r in safe.collect()) == [(1, 10), (1, 11), (2, 20), (3, 0)]


def test_lookup_default_is_for_unknown_keys_only(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("c",)], "brand_id string")
    dim = spark.createDataFrame([("a", 7), ("b", None)], "brand_id string, avg_price_point int")
    rows = {r.brand_id: r.avg_price_point for r in lookup_or(fact, dim, "brand_id", "avg_price_point", 500).collect()}
    assert rows == {"a": 7, "b": None, "c": 500}


def test_densify(spark):
    df = spark.createDataFrame([("a", day(0), 5.0), ("a", day(3), 7.0)], "store_id string, date date, sales_amount double")
    rows = densify(df, {"sales_amount": 0.0}).orderBy("date").collect()
    assert [r.sales_amount for r in rows] == [5.0, 0.0, 0.0, 7.0]


def test_cluster_stats_keep_empty_clusters(spark):
    df = spark.createDataFrame(
        [(0, "A", 10, 100), (0, "B", 20, 300), (0, "A", None, 200)],
        "cluster int, country string, store_size_sqm int, history_days int",
    )
    rows = cluster_stats(df, 2).orderBy("cluster").collect()
    assert (rows[0].num_stores, rows[0].avg_size, rows[0].avg_history_days) == (3, 15.0, 200.0)
    assert rows[0].countries == {"A": 2, "B": 1}
    assert (rows[1].num_stores, rows[1].avg_size) == (0, None)


def test_health_class_limits(spark):
    df = spark.createDataFrame([(4.99,), (5.0,), (7.99,), (8.0,)], "m double")
    assert [r.s for r in df.select(health_class(F.col("m")).alias("s")).collect()] == [
        "healthy", "warning", "warning", "critical"
    ]
