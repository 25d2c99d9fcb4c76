"""Physical plans: shuffles, pushed filters, pruned columns, no Python workers in batch."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.adapter import compare_models
from tallyloom.operators.forecast import history_windows
from tallyloom.operators.health import store_health
from tallyloom.operators.panel import future_spine, last_date
from tallyloom.operators.windows import calendar_window_features, window_features
from tallyloom.plans import retail
from tallyloom.plans.catalog import REGISTRY
from tallyloom.plans.features import build_features


def plan_of(df, capsys) -> str:
    df.explain("simple")
    return capsys.readouterr().out


def shuffles(plan: str) -> int:
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|Round)", plan))


@pytest.fixture(scope="module")
def sales(spark, tiny):
    return retail.sales_table(spark, tiny)


@pytest.mark.parametrize("build", [window_features, calendar_window_features])
def test_all_windows_share_one_shuffle_and_one_sort(sales, capsys, build):
    plan = plan_of(build(sales), capsys)
    assert shuffles(plan) == 1 and len(re.findall(r"\bSort \[", plan)) == 1


def test_health_is_one_shuffle_over_three_columns(sales, capsys):
    scored = sales.withColumn("prediction", F.lit(1.0))
    plan = plan_of(store_health(scored), capsys)
    assert shuffles(plan) == 1
    assert "ReadSchema: struct<store_id:bigint,sales_amount:double>" in plan


def test_comparison_is_one_pass(sales, capsys):
    scored = sales.withColumns({"prediction": F.lit(1.0), "adapted_prediction": F.lit(2.0)})
    assert plan_of(compare_models(scored), capsys).count("FileScan") == 1


def test_feature_table_computes_windows_once_without_python(spark, tiny, sales, capsys, monkeypatch):
    from tallyloom.plans import features as plans

    staged, real = [], plans.stage
    monkeypatch.setattr(plans, "stage", lambda df, name: staged.append(name) or real(df, name))

    features = build_features(
        sales, retail.stage(retail.store_dim(spark, tiny), "stores"), retail.brand_dim(spark, tiny),
        retail.stage(retail.external(spark, tiny), "external"),
    )
    plan = plan_of(features, capsys)
    assert sorted(staged) == ["brand-means", "label-codes", "windows"]
    assert shuffles(plan) == 0 and "Window" not in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_forecast_history_is_filtered_at_the_scan(sales, capsys):
    end = last_date(sales)
    spine = future_spine(sales.select("store_id").distinct(), end, 30, ["store_id"])
    rows = history_windows(spine, sales, since=last_date(sales, shift_days=-364))
    plan = plan_of(rows, capsys)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert re.search(r"DataFilters: \[isnotnull\(date#\d+\), \(date#\d+ >= Subquery", plan)


def test_panel_sums_lines_before_it_joins(spark, tiny, capsys):
    plan = plan_of(retail.panel(spark, tiny), capsys)
    lines = plan.index("lineitem.parquet")
    assert plan.index("Join") < plan.index("HashAggregate") < lines  # printed top down
    assert "l_tax" not in plan and "l_comment" not in plan


def test_feature_table_runs_compiled(spark, tiny):
    """The JVM compiles no method of more than 8,000 bytes; one row of a larger one is interpreted."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = REGISTRY["feature_table"](spark, tiny)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    parts = debug.codegenStringSeq(plan)
    sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    assert sizes and max(sizes) < 8000
