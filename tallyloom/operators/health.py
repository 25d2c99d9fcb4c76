"""Accuracy per store and its classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.metrics import is_valid, mae, mape
from tallyloom.functions.rules import HEALTH_STATES, health_class
from tallyloom.settings import DriftSettings

# Rows a store needs before and after the filter on valid sales.
MIN_ROWS, MIN_VALID_ROWS = 7, 3


def store_health(
    scored: DataFrame,
    settings: DriftSettings = DriftSettings(),
    store: str = "store_id",
    actual: str = "sales_amount",
    prediction: str = "prediction",
) -> DataFrame:
    """Table (store, num_days, mape, mae, avg_actual, avg_predicted, health_status), one pass."""
    y, p = F.col(actual), F.col(prediction)
    valid = is_valid(y)
    return (
        scored.groupBy(store)
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.count_if(valid).alias("num_days"),
            mape(y, p, valid).alias("mape"),
            mae(y, p, valid).alias("mae"),
            F.avg(F.when(valid, y)).alias("avg_actual"),
            F.avg(F.when(valid, p)).alias("avg_predicted"),
        )
        .filter((F.col("__rows") >= MIN_ROWS) & (F.col("num_days") >= MIN_VALID_ROWS))
        .drop("__rows")
        .withColumn("health_status", health_class(F.col("mape"), settings))
    )


def worst_first(health: DataFrame, store: str = "store_id") -> DataFrame:
    return health.orderBy(F.desc("mape"), store)


def health_counts(health: DataFrame) -> DataFrame:
    """Number and percentage of stores per state; all three states in a fixed order."""
    totals = health.agg(
        F.count(F.lit(1)).alias("__stores"),
        *[F.count_if(F.col("health_status") == s).alias(s) for s in HEALTH_STATES],
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(s).alias("health_status"),
            F.col(s).alias("stores"),
            F.coalesce(F.try_divide(F.col(s), F.col("__stores")) * 100, F.lit(0.0)).alias("percentage"),
        )
        for i, s in enumerate(HEALTH_STATES)
    ]
    return totals.select(F.inline(F.array(*rows)))


def critical_stores(health: DataFrame, top: int | None = 5, store: str = "store_id") -> DataFrame:
    """Critical stores, highest error first; the report shows the first five."""
    ordered = worst_first(health.filter(F.col("health_status") == "critical"), store)
    return ordered if top is None else ordered.limit(top)
