"""Accuracy measures as aggregate columns, so any grouping can use them in one pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: smallest denominator of a percentage error (float64 machine epsilon).
SMALLEST_ACTUAL = 2.220446049250313e-16


def absolute_percentage_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted) / F.greatest(F.abs(actual), F.lit(SMALLEST_ACTUAL))


def is_valid(actual: Column, above: float = 1.0) -> Column:
    """Rows with enough sales for a percentage error; unknown actuals are not valid."""
    return F.coalesce(actual > F.lit(above), F.lit(False))


def _mean(value: Column, where: Column | None) -> Column:
    return F.avg(value if where is None else F.when(where, value))


def mape(actual: Column, predicted: Column, where: Column | None = None) -> Column:
    return _mean(absolute_percentage_error(actual, predicted), where) * 100


def mae(actual: Column, predicted: Column, where: Column | None = None) -> Column:
    return _mean(F.abs(actual - predicted), where)


def rmse(actual: Column, predicted: Column, where: Column | None = None) -> Column:
    gap = actual - predicted
    return F.sqrt(_mean(gap * gap, where))


def accuracy(actual: Column, predicted: Column, where: Column | None = None, prefix: str = "") -> list[Column]:
    """MAPE, MAE and RMSE as named aggregate columns."""
    return [
        mape(actual, predicted, where).alias(f"{prefix}mape"),
        mae(actual, predicted, where).alias(f"{prefix}mae"),
        rmse(actual, predicted, where).alias(f"{prefix}rmse"),
    ]
