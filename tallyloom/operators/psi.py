"""Population stability index of many features at once.

The bins are the deciles of the baseline part. Both parts are counted in one pass
over the table, one output row per feature, so no feature is a hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.rules import psi_severity
from tallyloom.operators.quantiles import exact_quantiles, feature_names, packed_values, value_blocks
from tallyloom.sources.staging import stage
from tallyloom.settings import PSI_BINS, PSI_EPSILON, PSI_MISSING_SHARE, DriftSettings


def feature_psi(
    df: DataFrame,
    features: Sequence[str],
    baseline: Column,
    bins: int = PSI_BINS,
    null_policy: str = "strict",
) -> DataFrame:
    """Table (feature, psi). ``baseline`` is true for baseline rows and false for current ones.

    Bins are half open, (a, b], the first one closed; values outside the baseline range are
    left out and the shares rescaled. A part without any value in range gets a fixed small
    share per bin. ``null_policy='strict'`` gives 0 for a feature with a missing baseline
    value; ``'ignore'`` leaves missing values out. Fewer than two distinct edges give 0.
    """
    tagged = df.withColumn("__baseline", baseline)
    quantiles = exact_quantiles(tagged.filter("__baseline"), features, [i / bins for i in range(bins + 1)])
    first_bin = sum(((F.col(f"q{i}") <= F.col("q0")).cast("int") for i in range(bins + 1)), F.lit(0))
    place = F.array_position(F.array(*[F.lit(c) for c in features]), F.col("feature")) - 1
    placed_edges = quantiles.withColumns({"first_bin": first_bin, "feature": place.cast("int")})
    edges = stage(placed_edges, "psi-edges")
    names = [f"q{i}" for i in range(bins + 1)]
    low, high = F.col(names[0]), F.col(names[-1])
    by_bin = _bin_counts(tagged, features, edges, names)
    is_base, rows = F.col("__baseline"), F.col("rows")

    def rows_of(side: Column, where: Column) -> Column:
        return F.sum(F.when(side & where, rows).otherwise(0))

    bin_numbers = range(1, bins + 1)
    counts = by_bin.groupBy("feature").agg(  # at most 2 * bins rows per feature
        rows_of(is_base, F.lit(True)).alias("base_total"),
        rows_of(~is_base, F.lit(True)).alias("current_total"),
        *[rows_of(is_base, F.col("__bin") == i).alias(f"base{i}") for i in bin_numbers],
        *[rows_of(~is_base, F.col("__bin") == i).alias(f"current{i}") for i in bin_numbers],
    )
    joined = edges.join(F.broadcast(counts), "feature", "left")

    def share(side: str, i: int) -> Column:
        part = F.try_divide(F.col(f"{side}{i}"), F.col(f"{side}_total"))
        return F.coalesce(part, F.lit(PSI_MISSING_SHARE)) + F.lit(PSI_EPSILON)

    total = F.lit(0.0)
    for i in range(1, bins + 1):
        exists = F.col(names[i]) > F.col(names[i - 1])
        expected, actual = share("base", i), share("current", i)
        total = total + F.when(exists, (actual - expected) * F.log(actual / expected)).otherwise(F.lit(0.0))
    defined = (F.col("n") > 0) & (high > low)
    if null_policy == "strict":
        defined = defined & (F.col("missing") == 0)
    elif null_policy != "ignore":
        raise ValueError(f"null_policy must be 'strict' or 'ignore', not {null_policy!r}")
    return joined.select(feature_names(features).alias("feature"), F.when(defined, total).otherwise(F.lit(0.0)).alias("psi"))


def _bin_counts(tagged: DataFrame, features: Sequence[str], edges: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, __baseline, __bin, rows) of the values between the first and the last edge, counted
    where they are: a task returns one row per feature, part and bin."""
    width, bins = len(features), len(names) - 1
    # one row per feature, bounded by the schema
    cuts = {r["feature"]: ([r[n] for n in names], r["first_bin"]) for r in edges.collect() if r["n"]}

    def run(batches):
        counts = np.zeros((width, 3, bins + 2), np.int64)
        for block, held in value_blocks(batches, width):
            part = np.concatenate([b.column("part").to_numpy() for b in held])
            for i, (at, first) in cuts.items():
                values = block[i]
                # NaN is above all numbers here, as in Spark: infinite ends have it as an edge
                kept = (values >= at[0]) & (values <= (np.inf if np.isnan(at[-1]) else at[-1]))
                below = np.zeros(len(values), np.int8 if bins < 100 else np.int32)
                for edge in at:
                    below += values > edge
                place = np.maximum(below, first).astype(np.int64) + part * np.int64(bins + 2)
                counts[i] += np.bincount(place[kept], minlength=3 * (bins + 2)).reshape(3, -1)
        feature, side, number = np.nonzero(counts[:, :2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(feature.astype(np.int32)), pa.array(side == 1), pa.array(number.astype(np.int32)), pa.array(counts[feature, side, number])],
            names=["feature", "__baseline", "__bin", "rows"],
        )

    part = F.coalesce(F.col("__baseline").cast("int"), F.lit(2)).alias("part")  # 2: neither
    counted = tagged.select(part, packed_values(features)).mapInArrow(run, "feature int, __baseline boolean, __bin int, rows long")
    return counted.groupBy("feature", "__baseline", "__bin").agg(F.sum("rows").alias("rows"))


def psi_report(psi: DataFrame, settings: DriftSettings = DriftSettings()) -> DataFrame:
    """Add drift_detected and severity to a (feature, psi) table."""
    return psi.withColumns(
        {
            "drift_detected": F.col("psi") > F.lit(settings.psi_threshold),
            "severity": psi_severity(F.col("psi"), settings),
        }
    )
