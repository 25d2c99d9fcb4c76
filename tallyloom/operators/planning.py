"""Planning aggregates: weekly and monthly totals at several levels in one aggregation.

The levels are grouping sets, so Spark expands each row once per level (``Expand``), sums
map-side and shuffles the partial sums once; no level is a separate pass over the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAINS = ("week", "month")


def planning_aggregates(
    df: DataFrame,
    date: str = "date",
    dims: Sequence[str] = ("brand_id", "country"),
    amount: str = "sales_amount",
    count: str = "num_transactions",
    flag: str = "promotion_flag",
) -> DataFrame:
    """Totals per period of every grain in ``GRAINS`` (weeks from Monday, calendar months),
    for every leading part of ``dims`` and each single dim alone, and one grand total.

    With ``dims = (brand, country)`` the sets per grain are (period, brand, country),
    (period, brand), (period, country) and (period); with the grand total that is nine levels.
    ``level`` is Spark's ``grouping_id`` over (week, month, *dims): a bit is 1 where the column
    is summed over, the first column the highest bit. A null in a kept column is a group of its
    own, told apart from a summed-over column by ``level``; rows without a date form a null
    period of their own at every level. ``grain`` names the period
    column kept ('all' for the grand total) and ``period_start`` is its first day.

    Returns grain, period_start, *dims, level, row_count (rows), amount_total (sum of
    ``amount``, null if all null), count_total, flagged_rows (sum of ``flag``) and
    amount_per_row (amount_total / row_count). An empty input gives no rows: Spark's grouping
    sets, unlike SQL's, make no grand total row of nothing.
    """
    dims = list(dims)
    periods = df.select(
        F.trunc(date, "week").alias("__week"),
        F.trunc(date, "month").alias("__month"),
        *[F.col(d) for d in dims],
        F.col(amount).alias("__amount"),
        F.col(count).alias("__count"),
        F.col(flag).alias("__flag"),
    )
    sets = []
    for grain in GRAINS:
        g = F.col(f"__{grain}")
        sets += [[g, *[F.col(d) for d in dims[: k + 1]]] for k in range(len(dims))][::-1]
        sets += [[g, F.col(d)] for d in dims[1:]]
        sets.append([g])
    sets.append([])
    keys = [F.col("__week"), F.col("__month"), *[F.col(d) for d in dims]]
    out = periods.groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).alias("level"),
        F.count(F.lit(1)).alias("row_count"),
        F.sum("__amount").alias("amount_total"),
        F.sum("__count").alias("count_total"),
        F.sum("__flag").alias("flagged_rows"),
    )
    top = 1 << (len(dims) + 1)  # the week bit; the month bit is the next lower one
    grain = F.when(F.col("level").bitwiseAND(top) == 0, F.lit("week")).when(
        F.col("level").bitwiseAND(top >> 1) == 0, F.lit("month")
    ).otherwise(F.lit("all"))
    return out.select(
        grain.alias("grain"),
        F.coalesce("__week", "__month").alias("period_start"),
        *dims,
        "level",
        "row_count",
        "amount_total",
        "count_total",
        "flagged_rows",
        (F.col("amount_total") / F.col("row_count")).alias("amount_per_row"),
    )
