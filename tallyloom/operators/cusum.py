"""Two-sided CUSUM of a series, as window expressions.

With deviation x, slack k and zero start, the upper sum max(0, S + x - k) equals the
running sum C of (x - k) minus the smaller of 0 and the lowest C so far; the lower
sum mirrors it. A recurrence thereby becomes two windows over one ordering.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.rules import cusum_direction, cusum_drift
from tallyloom.settings import CUSUM_SLACK, CUSUM_THRESHOLD


def settled(total: Column) -> Column:
    """A sum without the noise of running totals, for comparison with a threshold: a sum that
    equals the threshold does not exceed it."""
    return F.round(total, 9)


def cusum_flags(df: DataFrame, threshold: float = CUSUM_THRESHOLD) -> DataFrame:
    """Add drift_detected and direction to cusum_pos and cusum_neg."""
    pos, neg = settled(F.col("cusum_pos")), settled(F.col("cusum_neg"))
    return df.withColumns(
        {"drift_detected": cusum_drift(pos, neg, threshold), "direction": cusum_direction(pos, neg)}
    )


def cusum_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    target: float = 0.0,
    slack: float = CUSUM_SLACK,
    threshold: float = CUSUM_THRESHOLD,
    segment: str | None = None,
) -> DataFrame:
    """CUSUM after every row of a panel series; a new ``segment`` value restarts from zero.

    For series whose length the calendar bounds. Use ``cusum_series_in_blocks`` for events.
    """
    spec = W.partitionBy(*keys, *([segment] if segment else [])).orderBy(*order)
    return cusum_flags(_zero_start(df, spec, F.col(value) - F.lit(target), slack), threshold).drop(
        "__up", "__down", "__low", "__high"
    )


def _zero_start(df: DataFrame, spec, deviation: Column, slack: float) -> DataFrame:
    running = spec.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        df.withColumns(
            {
                "__up": F.sum(deviation - F.lit(slack)).over(running),
                "__down": F.sum(deviation + F.lit(slack)).over(running),
            }
        )
        .withColumns({"__low": F.min("__up").over(running), "__high": F.max("__down").over(running)})
        .withColumns(
            {
                "cusum_pos": F.col("__up") - F.least(F.lit(0.0), F.col("__low")),
                "cusum_neg": F.col("__down") - F.greatest(F.lit(0.0), F.col("__high")),
            }
        )
    )


def cusum_series_in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    block: Column,
    target: float = 0.0,
    slack: float = CUSUM_SLACK,
    threshold: float = CUSUM_THRESHOLD,
    start: tuple[str, str] | None = None,
) -> DataFrame:
    """The same series for keys of any length, one task per (key, block) instead of per key.

    ``start`` names two columns, equal within a key, with the sums that a key starts from
    (upper >= 0, lower <= 0; a carried state); by default both are zero.

    ``block`` must not decrease in the order (an hour, a minute); choose it so fine that one
    block of the busiest key fits a task. Every block runs from zero; a block turns an entering
    sum s into max(end, s + total), so the sums that enter the blocks follow from one summary
    row per block, carried block by block in a grouped pandas step over the summaries of a key
    (its number of blocks, not of rows), and a row's sum is max(its sum from zero, s + its
    running total in the block). No total grows beyond one block, so long series keep their
    precision. The rows are shuffled once, by (key, block).
    """
    spec = W.partitionBy(*keys, "__block").orderBy(*order)
    local = _zero_start(df.withColumn("__block", block), spec, F.col(value) - F.lit(target), slack)
    pos0, neg0 = (F.col(c) for c in start) if start else (F.lit(0.0), F.lit(0.0))
    blocks = local.groupBy(*keys, "__block").agg(
        F.max(F.struct(*order, F.col("__up").alias("up"), F.col("__down").alias("down"))).alias("end"),
        F.min("__up").alias("low"),
        F.max("__down").alias("high"),
        F.first(pos0).alias("__pos0"),
        F.first(neg0).alias("__neg0"),
    )
    # A block turns an entering sum s into max(end, s + total) (upper) and min(end, s + total)
    # (lower); the entering sums follow block by block, one summary row per (key, block).
    summary = blocks.select(
        *keys, "__block", "__pos0", "__neg0",
        (F.col("end.up") - F.least(F.lit(0.0), "low")).alias("__end_up"), F.col("end.up").alias("__total_up"),
        (F.col("end.down") - F.greatest(F.lit(0.0), "high")).alias("__end_down"), F.col("end.down").alias("__total_down"),
    )
    by = [*keys, "__block"]
    schema = T.StructType([*(summary.schema[c] for c in by), T.StructField("__in_up", T.DoubleType()), T.StructField("__in_down", T.DoubleType())])

    def entering(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__block", na_position="first", kind="stable")
        up, down = float(frame["__pos0"].iloc[0]), float(frame["__neg0"].iloc[0])
        ins_up, ins_down = np.empty(len(frame)), np.empty(len(frame))
        ends_up, totals_up = frame["__end_up"].to_numpy(), frame["__total_up"].to_numpy()
        ends_down, totals_down = frame["__end_down"].to_numpy(), frame["__total_down"].to_numpy()
        for j in range(len(frame)):
            ins_up[j], ins_down[j] = up, down
            up, down = max(ends_up[j], up + totals_up[j]), min(ends_down[j], down + totals_down[j])
        return frame[by].assign(__in_up=ins_up, __in_down=ins_down)

    carried = summary.groupBy(*keys).applyInPandas(entering, schema)
    carried = carried.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(by)], "__in_up", "__in_down")
    # rows without a key or a block are a key or a block of their own
    same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(by)]
    local_up = F.col("__up") - F.least(F.lit(0.0), F.col("__low"))
    local_down = F.col("__down") - F.greatest(F.lit(0.0), F.col("__high"))
    joined = local.join(carried, same).withColumns(
        {
            "cusum_pos": F.greatest(local_up, F.col("__in_up") + F.col("__up")),
            "cusum_neg": F.least(local_down, F.col("__in_down") + F.col("__down")),
        }
    )
    return cusum_flags(joined.select(*df.columns, "cusum_pos", "cusum_neg"), threshold)


def cusum_once(
    error: Column, target: float = 0.0, slack: float = CUSUM_SLACK
) -> tuple[Column, Column]:
    """Both sums after one update from zero."""
    deviation = error - F.lit(target)
    return (
        F.greatest(F.lit(0.0), deviation - F.lit(slack)),
        F.least(F.lit(0.0), deviation + F.lit(slack)),
    )
