"""The four stages over files in the raw layout, and the sources and sinks between them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.model import feature_columns, feature_importance, load_model
from tallyloom.operators.quality import numeric_columns
from tallyloom.plans import retail
from tallyloom.plans.stages import run_features, run_forecast, run_monitoring, run_training
from tallyloom.schemas import BRANDS, EXTERNAL, FORECASTS, SALES, STORES
from tallyloom.settings import ForecastSettings, ModelSettings
from tallyloom.sources.tables import (
    read_csv_table,
    read_json_report,
    read_raw_tables,
    write_json_report,
    write_raw_tables,
)

SETTINGS = ModelSettings(trees=5, depth=4, learning_rate=0.4, min_adapter_rows=100)


def store_name(c):
    return F.format_string("STORE_%03d", c)


@pytest.fixture(scope="module")
def raw(spark, tiny, tmp_path_factory):
    """Raw tables in the declared schemas, written as CSV."""
    folder = str(tmp_path_factory.mktemp("raw"))
    panel, ext = retail.panel(spark, tiny), retail.external(spark, tiny)
    stores = retail.store_dim(spark, tiny)
    d = F.col("date")
    tables = {
        "sales": panel.withColumns(
            {
                "store_id": store_name(F.col("store_id")),
                "num_transactions": F.col("num_transactions").cast("int"),
                "day_of_week": F.weekday(d), "is_weekend": (F.weekday(d) >= 5).cast("int"),
                "month": F.month(d), "year": F.year(d),
            }
        ).select(SALES.fieldNames()),
        "stores": stores.withColumns(
            {
                "store_name": F.concat(F.lit("Store "), "store_id"),
                "opening_date": F.date_sub(F.lit("2001-11-04").cast("date"), F.col("history_days")),
                "is_ecommerce": F.lit(False),
                "store_id": store_name(F.col("store_id")),
            }
        ).select(STORES.fieldNames()),
        "brands": retail.brand_dim(spark, tiny).withColumns(
            {"brand_name": F.col("brand_id"), "seasonality_strength": F.lit(0.3)}
        ).select(BRANDS.fieldNames()),
        "external": ext.select(
            "date", "country", F.lit(3.0).alias("gdp_growth"), F.col("order_count").cast("double").alias("tourism_index"),
            F.lit(3.67).alias("currency_rate_to_usd"), (F.col("demand_index") / 1000).alias("temperature_celsius"),
            "is_public_holiday",
        ).select(EXTERNAL.fieldNames()),
    }
    write_raw_tables(tables, folder)
    return folder


@pytest.fixture(scope="module")
def features(spark, raw, tmp_path_factory):
    return run_features(spark, raw, str(tmp_path_factory.mktemp("store")))


@pytest.fixture(scope="module")
def models(features, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    run_training(features, folder, settings=SETTINGS)
    return folder


def test_feature_table_has_the_documented_columns(spark, raw, features):
    assert len(features.columns) == 55
    assert len(numeric_columns(features)) == 46
    assert features.columns[:15] == [*SALES.fieldNames()[:9], "day_of_week", "is_weekend", "month", "year", "day_of_month", "quarter"]
    assert features.columns[-1] == "sales_amount_rolling_min_30d"
    assert features.count() == read_raw_tables(spark, raw)["sales"].count()
    nulls = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features.columns]).first().asDict()
    assert {c for c, k in nulls.items() if k} == {
        "gdp_growth", "tourism_index", "currency_rate_to_usd", "temperature_celsius", "is_public_holiday",
    }


def test_model_inputs_leave_out_keys_text_and_target(features):
    inputs = feature_columns(features)
    assert "sales_amount" not in inputs and "month" not in inputs and "tier" not in inputs
    assert {"num_transactions", "sales_amount_lag_365d", "country_encoded"} <= set(inputs)


def test_training_beats_the_mean(spark, features, models):
    results = spark.read.json(f"{models}/training_results_v1.json").first()
    spread = features.agg(F.stddev_pop("sales_amount")).first()[0]
    assert 0 < results.global_rmse < spread
    assert results.valid_samples + results.zero_sales_samples == results.total_samples
    importance = feature_importance(spark, load_model(f"{models}/global_model_v1"), 5).collect()
    assert len(importance) == 5 and importance[0].importance >= importance[-1].importance


def test_forecasts_cover_every_store_and_day(spark, raw, features, models, tmp_path):
    tables = read_raw_tables(spark, raw)
    run_forecast(
        tables["stores"], tables["brands"], features, models, str(tmp_path),
        settings=ForecastSettings(horizon_days=10), model_settings=SETTINGS,
    )
    stored = read_csv_table(spark, f"{tmp_path}/forecasts_next_10days.csv", FORECASTS)
    assert stored.count() == 10 * features.select("store_id").distinct().count()
    bad = stored.filter("lower_bound < 0 or lower_bound > predicted_sales or upper_bound < predicted_sales or predicted_sales is null")
    assert bad.count() == 0
    last = features.agg(F.max("date")).first()[0]
    assert (stored.agg(F.min("date")).first()[0] - last).days == 1


def test_monitoring_writes_report_health_and_advice(spark, features, models, tmp_path):
    advice = run_monitoring(features, models, str(tmp_path)).collect()
    assert advice[0].position == 1
    report = spark.read.json(f"{tmp_path}/drift_detection_report.json").first()
    assert report.psi.total_features == 46
    details = report.psi.details.asDict()
    assert details["gdp_growth"].psi == 0.0  # a missing baseline value gives zero
    assert details["year"].drift_detected  # time halves always differ in the calendar


def test_json_report_keeps_nulls_and_turns_nan_to_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), None)], "a int, b double, c string")
    write_json_report(df, f"{tmp_path}/r.json")
    assert '"b":null' in "".join(p.read_text() for p in tmp_path.glob("r.json/part-*"))
    assert read_json_report(spark, f"{tmp_path}/r.json", df.schema).first() == (1, None, None)
