"""Lag and rolling columns of a panel.

A panel holds one row per store and day, so a store's window partition is bounded
by the length of the calendar however the rows are spread over stores. All columns
of one frame kind share a single partitioning and ordering: one shuffle, one sort.

Two frame kinds exist. Row frames count rows and include the current one; day
frames count calendar days and stop the day before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.settings import LAGS, WINDOWS


def _by_store(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(*order)


def lag_columns(spec: WindowSpec, target: str, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"{target}_lag_{n}d": F.lag(target, n).over(spec) for n in lags}


def rolling_columns(spec: WindowSpec, target: str, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for n in windows:
        frame = spec.rowsBetween(-(n - 1), W.currentRow)
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min)):
            out[f"{target}_rolling_{name}_{n}d"] = fn(target).over(frame)
    return out


def lag_features(
    df: DataFrame,
    keys: Sequence[str] = ("store_id",),
    order: Sequence[str] = ("date",),
    target: str = "sales_amount",
    lags: Sequence[int] = LAGS,
) -> DataFrame:
    """Value n rows earlier in the same store."""
    return df.withColumns(lag_columns(_by_store(keys, order), target, lags))


def rolling_features(
    df: DataFrame,
    keys: Sequence[str] = ("store_id",),
    order: Sequence[str] = ("date",),
    target: str = "sales_amount",
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Mean, sample deviation, maximum and minimum of the last n rows, this one included."""
    return df.withColumns(rolling_columns(_by_store(keys, order), target, windows))


def window_features(
    df: DataFrame,
    keys: Sequence[str] = ("store_id",),
    order: Sequence[str] = ("date",),
    target: str = "sales_amount",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Lags and rolling statistics together, over one shuffle and one sort."""
    spec = _by_store(keys, order)
    return df.withColumns(lag_columns(spec, target, lags) | rolling_columns(spec, target, windows))


def day_number(date: Column) -> Column:
    return F.unix_date(date)


def calendar_window_features(
    df: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales_amount",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    missing: float | None = 0.0,
) -> DataFrame:
    """Value exactly n days earlier, and statistics of the n days before the current one.

    Range frames on the day number give both, again over one shuffle. ``missing`` replaces
    an absent lag or an empty window; a deviation over one row stays NULL.
    """
    spec = W.partitionBy(*keys).orderBy(day_number(F.col(date)))

    def filled(value: Column, empty: Column) -> Column:
        return value if missing is None else F.when(empty, F.lit(missing)).otherwise(value)

    out: dict[str, Column] = {}
    for n in lags:
        value = F.min(target).over(spec.rangeBetween(-n, -n))
        out[f"{target}_lag_{n}d"] = filled(value, value.isNull())
    for n in windows:
        frame = spec.rangeBetween(-n, -1)
        empty = F.count(target).over(frame) == 0
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min)):
            out[f"{target}_rolling_{name}_{n}d"] = filled(fn(target).over(frame), empty)
    return df.withColumns(out)


def rolling_mape(
    df: DataFrame,
    actual: str = "sales_amount",
    predicted: str = "prediction",
    window: int = 7,
    keys: Sequence[str] = ("store_id",),
    order: Sequence[str] = ("date",),
    name: str = "rolling_mape",
) -> DataFrame:
    """Mean percentage error of the last n rows per store; rows with a zero actual are skipped."""
    frame = _by_store(keys, order).rowsBetween(-(window - 1), W.currentRow)
    error = F.abs(F.try_divide(F.col(actual) - F.col(predicted), F.col(actual))) * 100
    return df.withColumn(name, F.avg(error).over(frame))


__all__ = [
    "calendar_window_features",
    "day_number",
    "lag_columns",
    "lag_features",
    "rolling_columns",
    "rolling_features",
    "rolling_mape",
    "window_features",
]
