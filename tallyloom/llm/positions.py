"""Gapless positions of rows in key order, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.staging import stage


def positions(df: DataFrame, order: Sequence[Column], group: str | None = None, name: str = "position") -> DataFrame:
    """``df`` with the long column ``name``: 0, 1, ... in ``order`` (within ``group``, an int column).

    The rows are exchanged once, into key ranges, and written in key order; equal keys are told
    apart by their place in the input, so a key with many rows is dealt over several ranges. A
    row's position is its place in its range plus the rows of its group in earlier ranges, which
    are counted per range and group. Rows that are equal in ``order`` get positions in any order.
    """
    keys = ([F.col(group).asc()] if group else []) + list(order)
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, F.col("_tie").asc())
        .sortWithinPartitions(*keys, F.col("_tie").asc())
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    written = stage(ranged, "ranges").withColumn("_range", F.shiftright("_at", 33))
    by = ["_range", *([group] if group else [])]
    earlier = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(*by, "_first", "_before")
    )
    # one row per range and group; ranges are as many as shuffle partitions
    joined = written.join(F.broadcast(offsets), by)
    return joined.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_range", "_first", "_before")
