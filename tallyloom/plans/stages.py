"""The four stages over files: features, training, forecast, monitoring.

Each stage reads the tables of the stage before and writes its own, so a stage can be
re-run alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.metrics import is_valid, mae, mape, rmse
from tallyloom.operators.adapter import apply_adapters, compare_models, fit_adapters
from tallyloom.operators.drift import drift_report, error_summary, recommendations
from tallyloom.operators.forecast import (
    forecast_features,
    forecast_statistics,
    forecast_summary,
    prediction_intervals,
    top_stores,
)
from tallyloom.operators.health import store_health, worst_first
from tallyloom.operators.model import (
    feature_columns,
    fit_global_model,
    load_model,
    save_model,
    score,
)
from tallyloom.operators.psi import feature_psi, psi_report
from tallyloom.operators.quality import numeric_columns, quality_profile, table_metadata
from tallyloom.operators.split import baseline_split, time_split
from tallyloom.plans.features import build_features
from tallyloom.schemas import FORECASTS, RAW_TABLES
from tallyloom.settings import (
    DriftSettings,
    FeatureSettings,
    ForecastSettings,
    ModelSettings,
    SplitSettings,
)
from tallyloom.sources.staging import stage
from tallyloom.sources.tables import (
    read_features,
    read_raw_tables,
    write_csv,
    write_features,
    write_json_report,
)

# Fixed value: the validation MAPE where no row has enough sales.
VALIDATION_MAPE_WITHOUT_VALID_ROWS = 999.99


def run_features(
    spark: SparkSession,
    data: str,
    out: str,
    version: str = "v1",
    fmt: str = "csv",
    schemas: Mapping[str, T.StructType] = RAW_TABLES,
    settings: FeatureSettings = FeatureSettings(),
) -> DataFrame:
    """Raw tables -> quality report, feature table, metadata. Returns the stored features."""
    raw = read_raw_tables(spark, data, fmt, schemas)
    write_json_report(quality_profile(raw["sales"]), f"{out}/quality_{version}.json")
    features = build_features(raw["sales"], raw["stores"], raw["brands"], raw["external"], settings)
    write_features(features, out, version)
    stored = read_features(spark, out, version, features.columns)
    write_json_report(table_metadata(stored, version=version), f"{out}/metadata_{version}.json")
    return stored


def run_training(
    features: DataFrame,
    out: str,
    version: str = "v1",
    inputs: Sequence[str] | None = None,
    settings: ModelSettings = ModelSettings(),
    split: SplitSettings = SplitSettings(),
) -> DataFrame:
    """Feature table -> global model, adapters, accuracy on the test part (returned).

    The accuracy on the validation part is written as well (MAPE on valid rows, with the fallback
    where there is none, MAE and RMSE on all rows).
    """
    parts = time_split(features, split)
    train = parts.filter(F.col("split") == "train")
    columns = list(inputs) if inputs else feature_columns(features)
    save_model(fit_global_model(train, columns, settings), f"{out}/global_model_{version}")
    model = load_model(f"{out}/global_model_{version}")
    adapters_path = f"{out}/local_adapters_{version}.parquet"
    fit_adapters(score(train, model), settings).write.mode("overwrite").parquet(adapters_path)
    adapters = features.sparkSession.read.parquet(adapters_path)
    val = score(parts.filter(F.col("split") == "val"), model)
    write_json_report(validation_accuracy(val), f"{out}/validation_results_{version}.json")
    test = score(parts.filter(F.col("split") == "test"), model)
    results = compare_models(apply_adapters(test, adapters, settings))
    path = f"{out}/training_results_{version}.json"
    write_json_report(results, path)
    return features.sparkSession.read.schema(results.schema).json(path)


def validation_accuracy(scored: DataFrame) -> DataFrame:
    """One row: mape over valid rows, mae and rmse over all rows, valid_rows."""
    y, p = F.col("sales_amount"), F.col("prediction")
    return scored.agg(
        F.coalesce(mape(y, p, is_valid(y)), F.lit(VALIDATION_MAPE_WITHOUT_VALID_ROWS)).alias("mape"),
        mae(y, p).alias("mae"),
        rmse(y, p).alias("rmse"),
        F.count_if(is_valid(y)).alias("valid_rows"),
    )


def run_forecast(
    stores: DataFrame,
    brands: DataFrame,
    history: DataFrame,
    models: str,
    out: str,
    version: str = "v1",
    settings: ForecastSettings = ForecastSettings(),
    model_settings: ModelSettings = ModelSettings(),
) -> DataFrame:
    """Models and history -> forecasts with bounds, and a summary per store. A model input that
    future rows lack (a label code, the weekend flag) is taken from the store's latest row."""
    spark = history.sparkSession
    model = load_model(f"{models}/global_model_{version}")
    adapters = spark.read.parquet(f"{models}/local_adapters_{version}.parquet")
    rows = forecast_features(stores, brands, history, settings.horizon_days)
    absent = [c for c in model.stages[0].getInputCols() if c not in rows.columns]
    if absent:
        latest = history.groupBy("store_id").agg(*[F.max_by(c, "date").alias(c) for c in absent])
        rows = rows.join(latest, "store_id", "left")
    adapted = apply_adapters(score(rows, model), adapters, model_settings, name="predicted_sales")
    predicted = stage(
        adapted.select("date", "store_id", "brand_id", "country", "predicted_sales", "prediction_type"),
        "predictions",
    )
    forecasts = prediction_intervals(predicted, settings=settings).select(FORECASTS.fieldNames())
    write_csv(forecasts, f"{out}/forecasts_next_{settings.horizon_days}days.csv")
    stored = stage(forecasts, "forecasts")
    write_csv(forecast_summary(stored), f"{out}/forecast_summary.csv")
    write_json_report(forecast_statistics(stored), f"{out}/forecast_statistics.json")
    write_json_report(top_stores(stored), f"{out}/top_stores.json")
    return forecasts


def run_monitoring(
    features: DataFrame,
    models: str,
    out: str,
    version: str = "v1",
    settings: DriftSettings = DriftSettings(),
) -> DataFrame:
    """Feature table and model -> drift report, store health, advice (returned)."""
    spark = features.sparkSession
    model = load_model(f"{models}/global_model_{version}")
    scored = stage(score(baseline_split(features), model), "scored")
    baseline = F.col("period") == "baseline"
    psi = psi_report(feature_psi(scored, numeric_columns(features, ["store_id"]), baseline), settings)
    report = drift_report(error_summary(scored, baseline), psi, settings)
    path = f"{out}/drift_detection_report.json"
    write_json_report(report, path)
    stored = spark.read.schema(report.schema).json(path)
    health = store_health(scored.filter(~baseline), settings)
    write_csv(worst_first(health), f"{out}/store_health_dashboard.csv")
    stored_health = spark.read.schema(health.schema).option("header", True).csv(
        f"{out}/store_health_dashboard.csv"
    )
    advice = recommendations(stored, stored_health)
    write_json_report(advice, f"{out}/retraining_recommendations.json")
    return advice
