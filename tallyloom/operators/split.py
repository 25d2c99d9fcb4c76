"""Splits by row position in time order, without a global sort.

The cut row is found from a histogram of dates (one row per day) plus the position
of one key inside the day that the cut falls into. Tagging the rows is then a plain
comparison with the cut, so the table itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ranking import nth_key
from tallyloom.settings import BASELINE_RATIO, SplitSettings
from tallyloom.sources.staging import stage


def cut_rows(df: DataFrame, shares: Sequence[float], date: str = "date", tie: str = "store_id") -> DataFrame:
    """First row after each cut: (cut, cut_date, cut_key) for positions floor(n * share).

    (date, tie) must identify a row: of rows that share both, all fall on the side of the first.
    Rows without a date come last. A cut at or beyond the end has no row.
    """
    by_day = df.groupBy(date).agg(F.count(F.lit(1)).alias("__rows"))
    running = W.orderBy(F.col(date).asc_nulls_last())  # one row per calendar day
    total = F.sum("__rows").over(W.partitionBy())
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("cut"), F.floor(total * F.lit(float(s))).cast("long").alias("__at"))
            for i, s in enumerate(shares)
        ]
    )
    days = (
        by_day.withColumn("__upto", F.sum("__rows").over(running))
        .withColumn("__wanted", wanted)
        .select(date, "__rows", "__upto", F.inline("__wanted"))
        .filter((F.col("__at") < F.col("__upto")) & (F.col("__at") >= F.col("__upto") - F.col("__rows")))
        .select("cut", date, (F.col("__at") - F.col("__upto") + F.col("__rows")).alias("__offset"))
    )
    # `days` has one row per cut. Only keys of these days go on, and they are read three times.
    days = stage(days.withColumnRenamed(date, "cut_date"), "cuts")
    candidates = df.select(date, tie).join(F.broadcast(days), F.col(date).eqNullSafe(F.col("cut_date")))
    keys = nth_key(stage(candidates.select("cut", tie, "__offset"), "cut-days"), ["cut"], tie, "__offset", "cut_key")
    return days.select("cut", "cut_date").join(F.broadcast(keys), "cut")  # one row per cut


def tag_by_cuts(
    df: DataFrame,
    cuts: DataFrame,
    labels: Sequence[str],
    date: str = "date",
    tie: str = "store_id",
    name: str = "split",
) -> DataFrame:
    """Tag rows with the label of the part they fall into; ``labels`` has one more entry than cuts.

    The cut rows enter as one scalar subquery; a cut without a row leaves its part empty. Rows
    without a date are beyond every dated cut.
    """
    numbers = range(len(labels) - 1)
    first_row = F.struct("cut_date", "cut_key")
    rows = cuts.agg(
        F.struct(*[F.min(F.when(F.col("cut") == i, first_row)).alias(f"cut{i}") for i in numbers])
    ).scalar()

    def reached(i: int) -> Column:
        day, key = rows[f"cut{i}"]["cut_date"], rows[f"cut{i}"]["cut_key"]
        later = F.coalesce(F.col(date) > day, F.col(date).isNull() & day.isNotNull())
        return later | (F.col(date).eqNullSafe(day) & (F.col(tie) >= key))

    part = F.when(reached(numbers[-1]), labels[-1])
    for i in reversed(numbers[:-1]):
        part = part.when(reached(i), labels[i + 1])
    return df.withColumn(name, part.otherwise(labels[0]))


def time_split(
    df: DataFrame,
    settings: SplitSettings = SplitSettings(),
    date: str = "date",
    tie: str = "store_id",
    name: str = "split",
) -> DataFrame:
    """Tag every row train, val or test by its position in time order."""
    cuts = cut_rows(df, [settings.train, settings.train + settings.val], date, tie)
    return tag_by_cuts(df, cuts, ["train", "val", "test"], date, tie, name)


def baseline_split(
    df: DataFrame,
    share: float = BASELINE_RATIO,
    date: str = "date",
    tie: str = "store_id",
    name: str = "period",
) -> DataFrame:
    """Tag every row baseline (older) or current (recent)."""
    cuts = cut_rows(df, [share], date, tie)
    return tag_by_cuts(df, cuts, ["baseline", "current"], date, tie, name)
