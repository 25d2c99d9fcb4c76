"""Registered queries: one per operator, over the whole derived panel or event table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.calendar import CALENDAR_COLUMNS, calendar_events, calendar_features
from tallyloom.functions.metrics import accuracy, is_valid
from tallyloom.operators import cusum, drift, forecast, health, quality
from tallyloom.operators.adapter import apply_adapters, compare_models, fit_adapters
from tallyloom.operators.encode import label_codes, store_cluster_key
from tallyloom.operators.impute import impute_group_mean
from tallyloom.operators.joins import attach, with_history, without_history
from tallyloom.operators.model import (
    cluster_stats,
    cluster_stores,
    feature_columns,
    feature_importance,
    score,
    stored_model,
)
from tallyloom.operators.panel import future_spine, last_date
from tallyloom.operators.coldstart import cold_start_forecasts
from tallyloom.operators.factors import fit_factors
from tallyloom.operators.planning import planning_aggregates
from tallyloom.operators.psi import feature_psi, psi_report
from tallyloom.operators.split import baseline_split, time_split
from tallyloom.operators.windows import (
    calendar_window_features,
    lag_features,
    rolling_features,
    rolling_mape,
    window_features,
)
from tallyloom.plans import retail
from tallyloom.plans.features import ENCODED, SALES_COLUMNS, attributed, build_features
from tallyloom.schemas import FORECASTS, with_types
from tallyloom.settings import LAGS, ModelSettings
from tallyloom.sources.staging import checkpoint_root, stage
from tallyloom.sources.tables import (
    read_csv_table,
    read_features,
    read_json_report,
    read_raw_tables,
    write_csv,
    write_features,
    write_json_report,
    write_raw_tables,
)
from tallyloom.streaming import drain, drain_updates, read_stream, stream_quality
from tallyloom.streaming.carried import drain_cusum

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

HORIZON = 30
# National days of the derived panel, whose countries are regions.
REGION_DAYS = {"ASIA": (12, 2), "EUROPE": (9, 23)}
# Adapter threshold of the forecast queries, between the shortest and longest histories.
FORECAST_MODEL = ModelSettings(min_adapter_rows=420)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# Inputs of the panel, exact in both engines.
EXACT = ("sales_amount", "avg_transaction_value", "promotion_discount")
# Derived doubles that are settled in a column each.
FEW_DOUBLES = 6


def settled(c: Column) -> Column:
    """A derived double to four decimals, from 10,000 on to eight digits. NaN stays NaN.

    Two engines add the same doubles in a different order, so the last bits of a mean differ.
    Means of amounts in cents often lie on a decimal tie, so all values are moved by a little
    that is no multiple of a tie before they are rounded.
    """
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - 3)
    return (
        F.when(F.abs(c) < 5.3e-5, F.lit(0.0))
        .when(F.abs(c) < 10_000, F.round(c + F.lit(2.7182818e-6), 4))
        .when(F.isnan(c) | (F.abs(c) == float("inf")), c)
        .otherwise(F.round(c / scale + F.lit(2.7182818e-6), 4) * scale)
    )


def tidy(df: DataFrame, exact: Sequence[str] = EXACT) -> DataFrame:
    """Whole numbers as bigint, inputs (``exact``) unchanged, derived doubles settled.

    Many derived doubles are settled as one array: written out per column they make a generated
    method that is too large for the JVM to compile, and every row then runs interpreted.
    """
    derived = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exact]
    together = len(derived) > FEW_DOUBLES
    if together:
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in derived])
        others = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in derived]
        rows = df.select(*others, F.transform(values, settled).alias("__settled"))
    out = []
    for f in df.schema.fields:
        if f.name in derived:
            c = F.col("__settled")[derived.index(f.name)] if together else settled(F.col(f"`{f.name}`").cast("double"))
        else:
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.IntegralType):
                c = c.cast("bigint")
            elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                c = c.cast("double")
        out.append(c.alias(f.name))
    return (rows if together else df).select(*out)


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/runs/{name}-{uuid4().hex}"


# ---------------------------------------------------------------- panel and quality


@query
def panel_daily(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(retail.panel(spark, sf))


@query
def panel_densify(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(retail.panel_dense(spark, sf))


def _with_external(spark: SparkSession, sf: str, sales: DataFrame) -> DataFrame:
    return attach(sales, stage(retail.external(spark, sf), "external"), ["date", "country"])


@query
def quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(_with_external(spark, sf, retail.panel(spark, sf)), "profiled")
    return tidy(quality.quality_profile(rows))


@query
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = retail.table(spark, sf, "lineitem")
    return tidy(quality.duplicate_rows(lines.select("l_suppkey", F.to_date("l_shipdate"), "l_discount", "l_tax")))


@query
def outlier_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.flag_outliers(retail.sales_table(spark, sf), "sales_amount")
    return tidy(flagged.select("store_id", "date", "sales_amount", "is_outlier"))


@query
def feature_metadata(spark: SparkSession, sf: str) -> DataFrame:
    meta = quality.table_metadata(retail.panel(spark, sf))
    return tidy(meta.withColumn("features", F.array_join("features", ",")))


@query
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    stores = stage(retail.store_dim(spark, sf), "stores")
    return tidy(quality.dataset_summary(stores, retail.brand_dim(spark, sf), retail.panel(spark, sf)))


# ---------------------------------------------------------------- features


@query
def calendar_columns(spark: SparkSession, sf: str) -> DataFrame:
    sales = retail.panel(spark, sf).select("store_id", "date")
    return tidy(calendar_features(sales).select("store_id", "date", *CALENDAR_COLUMNS))


@query
def calendar_event_factors(spark: SparkSession, sf: str) -> DataFrame:
    sales = retail.panel(spark, sf).select("store_id", "date", "country")
    return tidy(calendar_events(sales, national_days=REGION_DAYS))


def _attributed_panel(spark: SparkSession, sf: str) -> DataFrame:
    stores = stage(retail.store_dim(spark, sf), "stores")
    return attributed(retail.panel(spark, sf), stores, retail.brand_dim(spark, sf))


@query
def dim_join(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(
        _attributed_panel(spark, sf).select(
            "store_id", "date", "location_type", "store_size_sqm", "tier",
            "category", "price_tier", "avg_price_point",
        )
    )


@query
def label_encoding(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(label_codes(_attributed_panel(spark, sf), ENCODED))


@query
def store_cluster_keys(spark: SparkSession, sf: str) -> DataFrame:
    stores = retail.store_dim(spark, sf)
    return tidy(stores.select("store_id", "tier", "location_type", store_cluster_key().alias("store_cluster")))


@query
def external_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = _with_external(spark, sf, retail.panel(spark, sf))
    return tidy(
        joined.select("store_id", "date", "country", "order_count", "demand_index", "is_public_holiday")
    )


@query
def lag_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(lag_features(retail.panel(spark, sf).select("store_id", "date", "sales_amount")))


@query
def rolling_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(rolling_features(retail.panel(spark, sf).select("store_id", "date", "sales_amount")))


@query
def calendar_window_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(calendar_window_features(retail.panel(spark, sf).select("store_id", "date", "sales_amount")))


@query
def impute_brand_mean(spark: SparkSession, sf: str) -> DataFrame:
    sales = retail.sales_table(spark, sf).select("store_id", "date", "brand_id", "sales_amount", "promotion_flag")
    columns = ["sales_amount_lag_7d", "sales_amount_lag_365d", "sales_amount_rolling_std_7d"]
    rows = window_features(sales).select("store_id", "date", "brand_id", "promotion_flag", *columns)
    return tidy(impute_group_mean(rows, [*columns, "promotion_flag"]))


@query
def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(
        build_features(
            retail.sales_table(spark, sf),
            stage(retail.store_dim(spark, sf), "stores"),
            retail.brand_dim(spark, sf),
            stage(retail.external(spark, sf), "external"),
        )
    )


@query
def feature_store_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Feature table through the versioned store, partitioned by year."""
    features = build_features(
        retail.sales_table(spark, sf),
        stage(retail.store_dim(spark, sf), "stores"),
        retail.brand_dim(spark, sf),
        stage(retail.external(spark, sf), "external"),
    )
    folder = fresh_folder(spark, "feature-store")
    write_features(features, folder)
    return tidy(read_features(spark, folder, columns=features.columns))


@query
def raw_tables_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The panel and the external table through CSV files with declared schemas."""
    tables = {"sales": retail.sales_table(spark, sf), "external": retail.external(spark, sf)}
    folder = fresh_folder(spark, "raw")
    write_raw_tables(tables, folder)
    raw = read_raw_tables(spark, folder, schemas={n: t.schema for n, t in tables.items()})
    joined = attach(raw["sales"], raw["external"], ["date", "country"])
    return tidy(joined.select(*SALES_COLUMNS, "order_count", "demand_index", "is_public_holiday"))


# ---------------------------------------------------------------- split, metrics, health


@query
def split_by_time(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(time_split(retail.sales_table(spark, sf)).select("store_id", "date", "split"))


@query
def split_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(baseline_split(retail.sales_table(spark, sf)).select("store_id", "date", "period"))


@query
def planning_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly and monthly totals per brand and country, per brand, per country, per period and
    overall: nine grouping sets, one shuffle of partial sums."""
    return tidy(planning_aggregates(retail.panel(spark, sf)))


@query
def brand_country_store_factors(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales as brand baseline x country factor x store factor, fixed rounds."""
    return tidy(fit_factors(retail.panel(spark, sf)))


@query
def cold_start(spark: SparkSession, sf: str) -> DataFrame:
    """Every store-day by months since opening: its cluster's mature mean, a 70/30 blend, or
    its own mean of earlier months; clusters are the store cluster keys (tier, location)."""
    clusters = retail.store_dim(spark, sf).select("store_id", store_cluster_key().alias("cluster"))
    return tidy(cold_start_forecasts(retail.panel(spark, sf), clusters))


@query
def accuracy_metrics(spark: SparkSession, sf: str) -> DataFrame:
    y, p = F.col("sales_amount"), F.col("prediction")
    valid = is_valid(y)
    parts = retail.scored(spark, sf).groupBy("split")
    return tidy(parts.agg(*accuracy(y, p, valid), F.count_if(valid).alias("valid_rows")))


@query
def rolling_error(spark: SparkSession, sf: str) -> DataFrame:
    rows = retail.scored(spark, sf).select("store_id", "date", "sales_amount", "prediction")
    return tidy(rolling_mape(rows).select("store_id", "date", "rolling_mape"))


def _health(spark: SparkSession, sf: str) -> DataFrame:
    return health.store_health(retail.scored(spark, sf).filter(F.col("split") != "train"))


@query
def store_health(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(health.worst_first(_health(spark, sf)))


@query
def store_health_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Health over the calendar-complete panel, whose zero days the valid-sales rule leaves out."""
    dense = retail.panel_dense(spark, sf).withColumn("prediction", F.lit(50000.0))
    return tidy(health.store_health(dense))


@query
def health_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(health.health_counts(_health(spark, sf)))


def graded(spark: SparkSession, sf: str) -> DataFrame:
    """The panel with a predictor whose error grows with the store number, so that stores of
    every health class occur."""
    share = 1 + (F.col("store_id") % 12 + F.lit(0.5)) / 100
    return retail.sales_table(spark, sf).withColumn("prediction", F.col("sales_amount") * share)


@query
def store_health_graded(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(health.store_health(graded(spark, sf)))


@query
def health_counts_graded(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(health.health_counts(health.store_health(graded(spark, sf))))


@query
def health_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = health.store_health(graded(spark, sf))
    path = fresh_folder(spark, "health")
    write_csv(health.worst_first(rows), path)
    return tidy(read_csv_table(spark, path, rows.schema))


# Errors of the current part in per cent, against 3 in the baseline: one for every severity.
DRIFT_CASES = (2.5, 4.5, 6.0, 9.0, 13.0)


@query
def mape_drift_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Severity and action for errors of every class, the worst of them with a general alarm."""
    tagged = baseline_split(retail.sales_table(spark, sf))
    is_baseline = F.col("period") == "baseline"
    out = None
    for percent in DRIFT_CASES:
        share = 1 + F.when(is_baseline, F.lit(3.0)).otherwise(F.lit(percent)) / 100
        scored = tagged.withColumn("prediction", F.col("sales_amount") * share)
        found = drift.mape_drift(drift.error_summary(scored, is_baseline)).drop("mean_residual")
        found = found.withColumn("percent", F.lit(percent))
        out = found if out is None else out.unionByName(found)
    return tidy(out)


@query
def critical_top5(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(health.critical_stores(_health(spark, sf)).select("store_id", "mape", "mae"))


# ---------------------------------------------------------------- adapters


@query
def adapter_fit(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(fit_adapters(retail.scored(spark, sf).filter(F.col("split") == "train")))


@query
def adapter_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "adapters")
    fit_adapters(retail.scored(spark, sf).filter(F.col("split") == "train")).write.parquet(path)
    return tidy(spark.read.parquet(path))


def _adapted(spark: SparkSession, sf: str) -> DataFrame:
    rows = retail.scored(spark, sf)
    adapters = stage(fit_adapters(rows.filter(F.col("split") == "train"), FORECAST_MODEL), "adapters")
    return apply_adapters(rows.filter(F.col("split") == "test"), adapters, FORECAST_MODEL)


@query
def adapted_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(
        _adapted(spark, sf).select("store_id", "date", "prediction", "adapted_prediction", "prediction_type")
    )


@query
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(compare_models(_adapted(spark, sf)))


# ---------------------------------------------------------------- drift


def _psi(spark: SparkSession, sf: str, sales: DataFrame | None = None) -> DataFrame:
    """Stability of every numeric feature; ``sales`` may come with its ``period`` already."""
    tagged = baseline_split(retail.sales_table(spark, sf)) if sales is None else sales
    features = build_features(
        tagged.select(*SALES_COLUMNS, "period"),
        stage(retail.store_dim(spark, sf), "stores"),
        retail.brand_dim(spark, sf),
        stage(retail.external(spark, sf), "external"),
    )
    names = quality.numeric_columns(features, exclude=["store_id"])
    # No pass over the features shuffles them, so they are derived from the staged windows each time.
    rows = features.select("period", *names)
    return psi_report(feature_psi(rows, names, F.col("period") == "baseline"))


@query
def psi_features(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_psi(spark, sf))


@query
def cusum_per_store(spark: SparkSession, sf: str) -> DataFrame:
    rows = retail.scored(spark, sf).select(
        "store_id",
        "date",
        F.year("date").alias("year"),
        ((F.col("sales_amount") - F.col("prediction")) / 10000).alias("error"),
    )
    series = cusum.cusum_series(rows, ["store_id"], ["date"], "error", slack=0.5, segment="year")
    return tidy(series.select("store_id", "date", "cusum_pos", "cusum_neg", "drift_detected", "direction"))


def _event_errors(spark: SparkSession, sf: str) -> DataFrame:
    return retail.table(spark, sf, "events").select(
        "user_id", "ts", "event_id", ((F.col("value") - 50) / 10).alias("error")
    )


@query
def cusum_per_user(spark: SparkSession, sf: str) -> DataFrame:
    series = cusum.cusum_series_in_blocks(
        _event_errors(spark, sf), ["user_id"], ["ts", "event_id"], "error", F.date_trunc("hour", "ts")
    )
    return tidy(series.drop("ts"))


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    """The training part holds the first 80 percent of the rows and serves as the baseline."""
    return drift.error_summary(retail.scored(spark, sf), F.col("split") == "train")


@query
def cusum_mean_residual(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.mean_residual_cusum(_errors(spark, sf)))


@query
def mape_drift(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.mape_drift(_errors(spark, sf)).drop("mean_residual"))


def _report(scored: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    is_baseline = F.col("split") == "train"
    rows = scored.withColumn("period", F.when(is_baseline, "baseline").otherwise("current"))
    psi = stage(_psi(spark, sf, rows), "psi")
    return drift.drift_report(drift.error_summary(scored, is_baseline), psi)


def _flat_report(report: DataFrame) -> DataFrame:
    return report.select(
        "mape.current_mape",
        "mape.baseline_mape",
        "mape.severity",
        "psi.drifted_features",
        "psi.total_features",
        "cusum.cusum_pos",
        "cusum.cusum_neg",
        "cusum.direction",
        "drift_detected",
        "recommended_action",
    )


@query
def drift_action(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_flat_report(_report(retail.scored(spark, sf), spark, sf)))


@query
def json_report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    report = _report(retail.scored(spark, sf), spark, sf)
    path = fresh_folder(spark, "report")
    write_json_report(report, path)
    return tidy(_flat_report(read_json_report(spark, path, report.schema)))


@query
def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    scored = retail.scored(spark, sf)
    stores = stage(health.store_health(scored.filter(F.col("split") != "train")), "health")
    return tidy(drift.recommendations(stage(_report(scored, spark, sf), "report"), stores))


# ---------------------------------------------------------------- forecast


@query
def future_days(spark: SparkSession, sf: str) -> DataFrame:
    history = retail.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("date")
    )
    stores = with_history(retail.store_dim(spark, sf), history)
    return tidy(future_spine(stores, last_date(history), HORIZON, ["store_id", "brand_id", "country"]))


@query
def stores_without_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Customers stand for stores here: those without any order have no history."""
    customers = retail.table(spark, sf, "customer").select(F.col("c_custkey").alias("store_id"))
    orders = retail.table(spark, sf, "orders").select(F.col("o_custkey").alias("store_id"))
    return tidy(without_history(customers, orders))


@query
def customers_without_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same for customers and events, where most customers have none."""
    customers = retail.table(spark, sf, "customer").select(F.col("c_custkey").alias("store_id"))
    users = retail.table(spark, sf, "events").select(F.col("user_id").alias("store_id"))
    return tidy(without_history(customers, users))


def _history_rows(spark: SparkSession, sf: str) -> DataFrame:
    history = retail.sales_table(spark, sf).select("store_id", "date", "sales_amount")
    stores = with_history(retail.store_dim(spark, sf), history)
    spine = future_spine(stores, last_date(history), HORIZON, ["store_id"])
    return forecast.history_windows(spine, history, since=last_date(history, shift_days=1 - max(LAGS)))


@query
def calendar_lag_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = _history_rows(spark, sf)
    return tidy(rows.select("store_id", "date", *[c for c in rows.columns if "_lag_" in c]))


@query
def range_window_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = _history_rows(spark, sf)
    return tidy(rows.select("store_id", "date", *[c for c in rows.columns if "_rolling_" in c]))


def _future_rows(spark: SparkSession, sf: str, history: DataFrame) -> DataFrame:
    stores = stage(retail.store_dim(spark, sf), "stores")
    return forecast.forecast_features(stores, retail.brand_dim(spark, sf), history, HORIZON)


@query
def forecast_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = _future_rows(spark, sf, retail.sales_table(spark, sf))
    names = [c for c in rows.columns if c not in CALENDAR_COLUMNS]
    return tidy(rows.select(*names, "day_of_week", "days_to_new_year"), exact=())


def _forecasts(spark: SparkSession, sf: str) -> DataFrame:
    rows, means = retail.scored_with_means(spark, sf)
    adapters = stage(fit_adapters(rows.filter(F.col("split") == "train"), FORECAST_MODEL), "adapters")
    spine = future_spine(
        with_history(retail.store_dim(spark, sf), rows),
        last_date(rows),
        HORIZON,
        ["store_id", "brand_id", "country"],
    )
    predicted = retail.predict_by_weekday(spine, means)
    adapted = apply_adapters(predicted, adapters, FORECAST_MODEL, name="predicted_sales")
    return forecast.prediction_intervals(stage(adapted, "predicted")).select(FORECASTS.fieldNames())


@query
def forecast_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_forecasts(spark, sf))


@query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "forecasts")
    write_csv(_forecasts(spark, sf), path)
    return tidy(read_csv_table(spark, path, with_types(FORECASTS, store_id="bigint")))


@query
def forecast_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(forecast.forecast_summary(_forecasts(spark, sf)))


@query
def forecast_summary_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = forecast.forecast_summary(_forecasts(spark, sf))
    path = fresh_folder(spark, "summary")
    write_csv(rows, path)
    return tidy(read_csv_table(spark, path, rows.schema))


@query
def forecast_types(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(forecast.stores_per_type(_forecasts(spark, sf)))


@query
def forecast_report(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(forecast.forecast_statistics(_forecasts(spark, sf)))


@query
def top_forecast_stores(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(forecast.top_stores(_forecasts(spark, sf)))


# ---------------------------------------------------------------- Spark ML


def _fit(spark: SparkSession, sf: str):
    features = build_features(
        retail.sales_table(spark, sf),
        stage(retail.store_dim(spark, sf), "stores"),
        retail.brand_dim(spark, sf),
        stage(retail.external(spark, sf), "external"),
    )
    parts = time_split(stage(features, "model-rows"))
    train = parts.filter(F.col("split") == "train")
    folder = f"{checkpoint_root(spark)}/models"
    return stored_model(train, feature_columns(features), folder, ModelSettings()), parts


@query
def gbt_forecast(spark: SparkSession, sf: str) -> DataFrame:
    model, parts = _fit(spark, sf)
    scored = score(parts.filter(F.col("split") == "test"), model)
    return tidy(scored.select("store_id", "date", "sales_amount", "prediction"))


@query
def gbt_feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(feature_importance(spark, _fit(spark, sf)[0]))


@query
def gbt_model_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What SQL can state of the stored model: every test row scored with a finite value, a test
    error below that of the training mean, importances that are not negative and sum to 1."""
    model, parts = _fit(spark, sf)
    mean = parts.filter(F.col("split") == "train").agg(F.avg("sales_amount")).first()[0]
    scored = score(parts.filter(F.col("split") == "test"), model)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    errors = scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count(F.when(finite, 1)).alias("finite_predictions"),
        F.avg((F.col("prediction") - F.col("sales_amount")) ** 2).alias("model_mse"),
        F.avg((F.lit(mean) - F.col("sales_amount")) ** 2).alias("mean_mse"),
    )
    weights = feature_importance(spark, model, top=None).agg(
        F.round(F.sum("importance"), 6).alias("importance_sum"), F.count(F.when(F.col("importance") < 0, 1)).alias("negative_importances")
    )
    checks = errors.crossJoin(weights).select(
        "test_rows", "finite_predictions", (F.col("model_mse") < F.col("mean_mse")).alias("beats_mean"), "importance_sum", "negative_importances"
    )
    return tidy(checks)


@query
def store_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(cluster_stores(stage(retail.store_dim(spark, sf), "stores")))


@query
def store_cluster_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics per group, with the store key modulo twelve as a group that SQL can state."""
    stores = retail.store_dim(spark, sf).withColumn("cluster", (F.col("store_id") % 12).cast("int"))
    stats = cluster_stats(stores, 12)
    pairs = F.transform(
        F.map_entries("countries"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))
    )
    return tidy(stats.withColumn("countries", F.array_join(pairs, ",")))


# ---------------------------------------------------------------- streaming


def _arrivals(spark: SparkSession, sf: str, columns: DataFrame) -> list[DataFrame]:
    """The first and the second half of the time range, as two deliveries."""
    middle = retail.table(spark, sf, "events").agg(
        F.expr("min(ts) + (max(ts) - min(ts)) / 2")
    ).scalar()
    return [columns.filter(F.col("ts") < middle), columns.filter(F.col("ts") >= middle)]


def _stream_twice(spark: SparkSession, deliveries: list[DataFrame], build) -> DataFrame:
    """Write a delivery, drain the stream, and again: the second run continues from the first."""
    base = fresh_folder(spark, "stream")
    schema = deliveries[0].schema
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{base}/in")
        out = drain(build(read_stream(spark, f"{base}/in", schema)), f"{base}/out", f"{base}/checkpoint")
    return out


@query
def cusum_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries through foreachBatch jobs in hour blocks, continued from carried sums."""
    base = fresh_folder(spark, "stream")
    deliveries = _arrivals(spark, sf, _event_errors(spark, sf))
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{base}/in")
        stream = read_stream(spark, f"{base}/in", deliveries[0].schema)
        out = drain_cusum(stream, f"{base}/cusum", f"{base}/checkpoint", "user_id", "error")
    stamped = out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).drop("batch")
    return tidy(stamped)


@query
def stream_quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    """All windows after two deliveries, the open ones included, and the rows that came too late."""
    events = retail.table(spark, sf, "events").select("ts", "event_type", "value")
    base, late = fresh_folder(spark, "stream"), 0
    for rows in _arrivals(spark, sf, events):
        rows.write.mode("append").parquet(f"{base}/in")
        windows = stream_quality(read_stream(spark, f"{base}/in", rows.schema))
        out, dropped = drain_updates(
            windows, f"{base}/out", f"{base}/checkpoint", ["window_start", "event_type"], "window_end"
        )
        late += dropped
    days = out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")).drop("window_end")
    return tidy(days.withColumn("late_rows", F.lit(late)))
