"""Positions in a sorted group without putting the group into one task.

A fixed number of keys per group, those with the smallest hash, cut the group into
contiguous ranges. The choice depends on the data only, so a re-run of a lost task
cuts at the same keys. Rows are numbered inside their range and shifted by the
number of rows in the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGES = 128


def _ranged(df: DataFrame, group: Sequence[str], key: str, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their range number, and the number of rows before each range."""
    sampled = W.partitionBy(*group).orderBy(F.col("__hash"), F.col(key))
    cuts = (
        df.select(*group, key, F.xxhash64(key).alias("__hash"))
        .withColumn("__nth", F.row_number().over(sampled))
        .filter(F.col("__nth") < ranges)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_set(key)).alias("__cuts"))
    )
    # One row of at most `ranges` keys per group; callers keep the number of groups fixed.
    rows = df.join(F.broadcast(cuts), list(group), "left").withColumn(
        "__range", F.size(F.filter("__cuts", lambda c: c < F.col(key)))
    )
    before = W.partitionBy(*group).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    return rows.drop("__cuts"), sizes


def positions(
    df: DataFrame, group: Sequence[str], key: str, name: str = "position", ranges: int = RANGES
) -> DataFrame:
    """Zero-based position of each row in its group, ordered by a unique non-null key.

    For a number of groups that is fixed by the caller (columns of a table, cuts of a split).
    """
    rows, sizes = _ranged(df, group, key, ranges)
    inside = W.partitionBy(*group, "__range").orderBy(key)
    offsets = F.broadcast(sizes.drop("__rows"))  # at most `ranges` rows per group
    return (
        rows.withColumn("__inside", F.row_number().over(inside))
        .join(offsets, [*group, "__range"])
        .withColumn(name, (F.col("__before") + F.col("__inside") - 1).cast("long"))
        .drop("__inside", "__before", "__range")
    )


def nth_key(
    df: DataFrame, group: Sequence[str], key: str, wanted: str, name: str = "nth", ranges: int = RANGES
) -> DataFrame:
    """Per group the key at zero-based position ``wanted`` (a column constant in the group).

    Only the rows of the one range that holds the position are sorted.
    """
    rows, sizes = _ranged(df, group, key, ranges)
    holds = (F.col(wanted) >= F.col("__before")) & (F.col(wanted) < F.col("__before") + F.col("__rows"))
    targets = df.select(*group, wanted).distinct()
    chosen = sizes.join(targets, list(group)).filter(holds).select(*group, "__range", "__before")
    inside = W.partitionBy(*group, "__range").orderBy(key)
    return (
        rows.join(F.broadcast(chosen), [*group, "__range"])  # one row per group
        .withColumn("__inside", F.row_number().over(inside))
        .filter(F.col("__inside") - 1 == F.col(wanted) - F.col("__before"))
        .select(*group, F.col(key).alias(name))
    )
