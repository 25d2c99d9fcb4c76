"""Date spines: complete a panel over its calendar, or extend it into the future."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def days_between(first: Column, last: Column) -> Column:
    """One row per day, both ends included."""
    return F.explode(F.sequence(first, last))


def store_spine(
    stores: DataFrame, first: Column, last: Column, keep: Sequence[str], date: str = "date"
) -> DataFrame:
    """One row per store and day from the store's first day on."""
    return stores.select(*keep, days_between(first, last).alias(date))


def densify(
    panel: DataFrame,
    fills: Mapping[str, object],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
) -> DataFrame:
    """Every day of each store between its first and last row; new days take ``fills``.

    The spine has the calendar's length per store and is joined on the panel key.
    """
    spans = panel.groupBy(*keys).agg(F.min(date).alias("__first"), F.max(date).alias("__last"))
    spine = spans.select(*keys, days_between(F.col("__first"), F.col("__last")).alias(date))
    filled = spine.join(panel, [*keys, date], "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def last_date(history: DataFrame, date: str = "date", shift_days: int = 0) -> Column:
    """Latest date of a table, moved by some days, as a scalar subquery. The move is part of the
    subquery, so that a filter compares with a plain value and reaches the file scan."""
    return history.agg(F.date_add(F.max(date), shift_days)).scalar()


def future_dates(after: Column, horizon_days: int) -> Column:
    """One row per day: the ``horizon_days`` days after a date."""
    return days_between(F.date_add(after, 1), F.date_add(after, horizon_days))


def future_spine(
    stores: DataFrame, after: Column, horizon_days: int, keep: Sequence[str], date: str = "date"
) -> DataFrame:
    """Every store with every future day. Days are generated per row, nothing is joined."""
    return stores.select(*keep, future_dates(after, horizon_days).alias(date))
