"""Dimension joins.

No join here carries a hint for a table whose size is unknown. Dimensions are
tables on disk (raw or staged), so the planner knows their real size: it
broadcasts below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise runs a
sort-merge join whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left join of ``columns`` (default: all that the fact lacks). A repeated dimension key
    repeats the fact row; with ``null_safe`` a NULL key matches a NULL key."""
    wanted = [c for c in (columns or dimension.columns) if c not in fact.columns and c not in keys]
    right = dimension.select(*keys, *wanted)
    if not null_safe:
        return fact.join(right, list(keys), "left")
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *wanted)
    match: Column = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return fact.join(renamed, match, "left").drop(*[f"__{k}" for k in keys])


def with_history(stores: DataFrame, history: DataFrame, key: str = "store_id") -> DataFrame:
    """Stores that have at least one history row."""
    return stores.join(history.select(key).distinct(), key, "left_semi")


def without_history(stores: DataFrame, history: DataFrame, key: str = "store_id") -> DataFrame:
    return stores.join(history.select(key).distinct(), key, "left_anti")


def lookup_or(fact: DataFrame, dimension: DataFrame, key: str, column: str, default: object) -> DataFrame:
    """Left lookup of one column with a constant where the key is unknown. A known key keeps
    its stored value, NULL included."""
    right = dimension.select(key, column, F.lit(True).alias("__found"))
    joined = fact.join(right, key, "left")
    value = F.when(F.col("__found"), F.col(column)).otherwise(F.lit(default))
    return joined.withColumn(column, value).drop("__found")
