"""Feature rows of future days, prediction intervals and forecast summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.calendar import calendar_features
from tallyloom.operators.joins import lookup_or
from tallyloom.operators.panel import future_spine, last_date
from tallyloom.operators.quantiles import exact_quantiles
from tallyloom.operators.windows import calendar_window_features
from tallyloom.settings import (
    DEFAULT_PRICE_POINT,
    FUTURE_EXTERNALS,
    LAGS,
    WINDOWS,
    ForecastSettings,
)
from tallyloom.sources.staging import stage


def store_history(history: DataFrame, store: str = "store_id") -> DataFrame:
    """Per store: mean transactions cut to a whole number, and mean transaction value."""
    return history.groupBy(store).agg(
        F.avg("num_transactions").cast("int").alias("num_transactions"),
        F.avg("avg_transaction_value").alias("avg_transaction_value"),
    )


def history_windows(
    spine: DataFrame,
    history: DataFrame,
    store: str = "store_id",
    date: str = "date",
    target: str = "sales_amount",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    since: Column | None = None,
) -> DataFrame:
    """Calendar lags and window statistics of ``history`` for the rows of ``spine``.

    Spine and history are stacked and read through range frames, instead of a range join
    that would repeat every history row per window. Only history within reach of the
    first spine day is read; pass the earliest such day as ``since`` where it is known.
    """
    if since is None:
        since = spine.agg(F.date_sub(F.min(date), max([*lags, *windows]))).scalar()
    recent = history.filter(F.col(date) >= since)
    stacked = spine.select(store, date, F.lit(None).cast("double").alias(target), F.lit(True).alias("__new"))
    stacked = stacked.unionByName(recent.select(store, date, target, F.lit(False).alias("__new")))
    windowed = calendar_window_features(stacked, [store], date, target, lags, windows)
    return windowed.filter("__new").drop("__new", target)


def forecast_features(
    stores: DataFrame,
    brands: DataFrame,
    history: DataFrame,
    horizon_days: int = 30,
    externals: Mapping[str, object] = FUTURE_EXTERNALS,
    store: str = "store_id",
    date: str = "date",
    target: str = "sales_amount",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Feature rows for every store with history and every day of the horizon.

    Calendar, lags and windows come from history up to its last date (lags are not fed
    with forecasts), transactions are store means, external values are constants and no
    promotion runs.
    """
    averages = store_history(history, store)
    known = stores.select(store, "brand_id", "country", "store_size_sqm").dropDuplicates([store])
    known = known.join(averages, store)  # the inner join also drops stores without history
    known = lookup_or(known, brands, "brand_id", "avg_price_point", DEFAULT_PRICE_POINT)
    # One row per store. Staged, the means over all history are taken once, not per use.
    known = stage(known, "forecast-stores")
    end = last_date(history, date)
    keys = future_spine(known, end, horizon_days, [store], date)
    since = last_date(history, date, 1 - max([*lags, *windows]))
    windowed = history_windows(keys, history, store, date, target, lags, windows, since)
    rows = calendar_features(windowed.join(known, store), date)
    constants = {**externals, "promotion_flag": 0, "promotion_discount": 0.0}
    return rows.withColumns({c: F.lit(v) for c, v in constants.items()})


def prediction_intervals(
    predicted: DataFrame, prediction: str = "predicted_sales", settings: ForecastSettings = ForecastSettings()
) -> DataFrame:
    """Add bounds at a share of the population deviation of all predictions; the lower bound is
    never negative."""
    spread = predicted.agg(F.stddev_pop(prediction)).scalar()
    half = F.lit(settings.z_score) * (spread * F.lit(settings.std_share))
    return predicted.withColumns(
        {
            "lower_bound": F.greatest(F.lit(0.0), F.col(prediction) - half),
            "upper_bound": F.col(prediction) + half,
            "confidence_level": F.lit(settings.confidence),
        }
    )


def forecast_summary(forecasts: DataFrame, store: str = "store_id") -> DataFrame:
    """Per store: total and mean forecast, and the prediction type (one per store)."""
    return forecasts.groupBy(store, "brand_id", "country").agg(
        F.sum("predicted_sales").alias("total_forecast"),
        F.avg("predicted_sales").alias("avg_daily_forecast"),
        F.min("prediction_type").alias("prediction_type"),
    )


def stores_per_type(forecasts: DataFrame, store: str = "store_id") -> DataFrame:
    return forecasts.groupBy("prediction_type").agg(F.countDistinct(store).alias("stores"))


def forecast_statistics(forecasts: DataFrame, store: str = "store_id", date: str = "date") -> DataFrame:
    """One row: period, coverage, total, mean and exact median of the forecasts."""
    median = exact_quantiles(forecasts, ["predicted_sales"], [0.5]).select("q0").scalar()
    return forecasts.agg(
        F.min(date).alias("start"),
        F.max(date).alias("end"),
        F.countDistinct(date).alias("days"),
        F.countDistinct(store).alias("stores"),
        F.countDistinct("brand_id").alias("brands"),
        F.countDistinct("country").alias("countries"),
        F.sum("predicted_sales").alias("total_sales"),
        F.avg("predicted_sales").alias("avg_daily_sales"),
    ).withColumn("median_daily_sales", median)


def top_stores(forecasts: DataFrame, top: int = 5, store: str = "store_id") -> DataFrame:
    """Stores with the highest total forecast."""
    totals = forecasts.groupBy(store).agg(F.sum("predicted_sales").alias("total_forecast"))
    return totals.orderBy(F.desc("total_forecast"), store).limit(top)
