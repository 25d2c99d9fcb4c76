"""Exact quantiles of many columns with bounded memory and a small shuffle.

A double has a whole number of 64 bits in the same order. Tasks count values by the leading bits of
that number (22 at first, so a bucket is 0.1 % wide), block by block in numpy, and
only counts are shuffled. The counts tell which buckets hold a wanted rank; these are counted again
by 12 more bits while they hold many rows. Only values of the buckets that are left are counted one
by one, dealt into ranges of (column, bucket, value) and ranked, each range in a task of its own.
Values in other buckets are read but never shuffled. The result is exact for any values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.sources.staging import stage

#: bits of the order number that a bucket of each round leaves open
BITS = (42, 30, 18, 6)
#: values of a task that are sorted at once, and counts that it keeps before it returns them
BLOCK, KEPT = 1 << 22, 1 << 20
#: buckets of wanted ranks are cut again while they may hold more distinct values than this share of all values, and than this number
SMALL_SHARE, FEW_ROWS = 0.05, 1_000_000

_SIGN = np.int64(2**63 - 1)


def packed_values(columns: Sequence[str]) -> Column:
    """The columns as one array of doubles: Java does not compile a loop that writes one by one, and
    a task is sent an array six times as fast."""
    return F.array(*[F.col(c).cast("double") for c in columns]).alias("values")


def value_blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, list[pa.RecordBatch]]]:
    """Values of several batches, one row per column (missing values are NaN), and the batches."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows * width
        if size >= BLOCK:
            yield _block(held, width), held
            held, size = [], 0
    if size:
        yield _block(held, width), held


def _block(batches: list[pa.RecordBatch], width: int) -> np.ndarray:
    rows = [b.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for b in batches]
    return np.ascontiguousarray(np.concatenate(rows).T)


def _order_number(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values; both zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & _SIGN)


def _most_values(bucket: Row) -> int:
    """The most distinct values that the bucket can hold: sines of equal angles differ in their last bits."""
    lo, hi = _order_number(np.array([bucket["lo"], bucket["hi"]])).tolist()
    return min(bucket["rows"], hi - lo + 1)


def _value(numbers: np.ndarray) -> np.ndarray:
    return (numbers ^ ((numbers >> 63) & _SIGN)).view(np.float64)


def feature_names(columns: Sequence[str]) -> Column:
    """The name of the column at place ``feature``."""
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("feature") + 1)


def _bucket_counts(df: DataFrame, columns: Sequence[str], bits: int, chosen: Sequence[Row] = (), chosen_bits: int = 0) -> DataFrame:
    """(feature, bucket, rows, lo, hi): known values by their order number without its last ``bits``
    bits, and the ends of each bucket. The first round also counts missing values, as bucket NULL;
    later ones count only inside the buckets ``chosen`` before, at most two per column and rank.
    """
    width = len(columns)
    inside = [np.array(sorted(r["bucket"] for r in chosen if r["feature"] == i), np.int64) for i in range(width)]
    everything = not chosen_bits

    def merged(parts):
        buckets, rows, lo, hi = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(buckets, kind="stable")
        buckets = buckets[order]
        first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
        return (
            buckets[first], np.add.reduceat(rows[order], first),
            np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first),
        )

    def table(parts):
        for i, found in parts.items():
            buckets, rows, lo, hi = merged(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(rows), i, np.int32)), pa.array(buckets), pa.array(rows),
                    pa.array(_value(lo)), pa.array(_value(hi)),
                ],
                names=["feature", "bucket", "rows", "lo", "hi"],
            )

    def run(batches):
        parts, kept, missing = {}, 0, np.zeros(width, np.int64)
        for block, _ in value_blocks(batches, width):
            for i, values in enumerate(block):
                if not everything and not len(inside[i]):
                    continue
                known = values[~np.isnan(values)]
                missing[i] += len(values) - len(known)
                numbers = np.sort(_order_number(known))
                if not everything:
                    starts = np.searchsorted(numbers, inside[i] << chosen_bits)
                    ends = np.searchsorted(numbers, (inside[i] << chosen_bits) + ((1 << chosen_bits) - 1), side="right")
                    numbers = np.concatenate([numbers[a:b] for a, b in zip(starts, ends)])
                if not len(numbers):
                    continue
                buckets = numbers >> bits
                first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
                upto = np.append(first[1:], len(numbers))
                parts.setdefault(i, []).append((buckets[first], upto - first, numbers[first], numbers[upto - 1]))
                kept += len(first)
            if kept > KEPT:
                parts = {i: [merged(found)] for i, found in parts.items()}
                kept = sum(len(found[0][0]) for found in parts.values())
                if kept > KEPT // 2:
                    yield from table(parts)
                    parts, kept = {}, 0
        yield from table(parts)
        if everything:
            none = pa.nulls(width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width, dtype=np.int32)), none.cast(pa.int64()), pa.array(missing), none.cast(pa.float64()), none.cast(pa.float64())],
                names=["feature", "bucket", "rows", "lo", "hi"],
            )

    counted = df.select(packed_values(columns)).mapInArrow(run, "feature int, bucket long, rows long, lo double, hi double")
    return counted.groupBy("feature", "bucket").agg(F.sum("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _known_counts(sizes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n, missing): known and missing values, one row per column."""
    is_missing, rows = F.col("bucket").isNull(), F.col("rows")
    counts = sizes.groupBy("feature").agg(
        F.sum(F.when(~is_missing, rows)).alias("n"), F.sum(F.when(is_missing, rows)).alias("missing")
    )
    features = sizes.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("feature"))
    return features.join(counts, "feature", "left").na.fill(0, ["n", "missing"])


def _held(sizes: DataFrame, ranks: DataFrame) -> DataFrame:
    """Every wanted rank with the bucket that holds it, counted from the start of that bucket.

    ``sizes`` has at most 4 million rows per feature in the first round, and 4,096 per feature and
    wanted rank in later ones.
    """
    upto = W.partitionBy("feature", "parent").orderBy("bucket")
    placed = sizes.withColumn("before", F.sum("rows").over(upto) - F.col("rows"))
    held = placed.join(F.broadcast(ranks), ["feature", "parent"]).filter(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows"))
    )
    rank = (F.col("rank") - F.col("before")).alias("rank")
    return held.select("feature", "number", "upper", "weight", rank, F.col("bucket").alias("parent"), "rows", "lo", "hi")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Table (feature, n, missing, q0, q1, ...) with linear interpolation between ranks.

    Quantiles are over known values and NULL for a column without any. ``df`` is read once per round
    of buckets (one as a rule, more for values that lie close together) and once for the values.
    """
    sizes = stage(_bucket_counts(df, columns, BITS[0]), "bucket-counts")
    known = stage(_known_counts(sizes, columns), "known-counts")
    ranks = _wanted_ranks(known, probabilities).withColumn("parent", F.lit(0).cast("long"))
    values = known.agg(F.sum("n")).first()[0] or 0
    sizes = sizes.filter(F.col("bucket").isNotNull()).withColumn("parent", F.lit(0).cast("long"))
    for i, bits in enumerate(BITS):
        # two rows per probability and feature
        held = stage(_held(sizes, ranks), "bucket-ranks")
        ranks = held.drop("rows", "lo", "hi")
        chosen = held.select("feature", F.col("parent").alias("bucket"), "lo", "hi", "rows").distinct().collect()
        left = sum(_most_values(r) for r in chosen if r["lo"] < r["hi"])
        finer = BITS[i + 1] if i + 1 < len(BITS) and left > max(FEW_ROWS, SMALL_SHARE * values) else 0
        parent = F.shiftright("bucket", bits - finer).alias("parent")
        counts = _bucket_counts(df, columns, finer, chosen, bits)
        if not finer:
            break
        sizes = counts.select("feature", parent, "bucket", "rows", "lo", "hi")
    counted = counts.select("feature", parent, F.col("lo").alias("value"), F.col("rows").alias("times"))
    ranged = stage(
        counted.repartitionByRange("feature", "parent", "value").withColumn("range", F.spark_partition_id()),
        "value-counts",
    )
    bucket = ["feature", "parent"]
    upto_range = W.partitionBy(*bucket).orderBy("range")  # one row per range and bucket
    sizes = (
        ranged.groupBy(*bucket, "range")
        .agg(F.sum("times").alias("rows"))
        .withColumn("before", F.sum("rows").over(upto_range) - F.col("rows"))
    )
    wanted = F.broadcast(ranks)
    held = (
        sizes.join(wanted, bucket)
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows")))
        .select(*bucket, "range", "before", "number", "upper", "weight", "rank")
    )
    chosen = held.select(*bucket, "range", "before").distinct()
    upto = W.partitionBy(*bucket, "range").orderBy("value")
    ranked = ranged.join(F.broadcast(chosen), [*bucket, "range"]).withColumn(
        "last", F.col("before") + F.sum("times").over(upto)
    )
    hits = ranked.drop("before").join(F.broadcast(held), [*bucket, "range"]).filter(
        (F.col("rank") >= F.col("last") - F.col("times")) & (F.col("rank") < F.col("last"))
    )
    ends = hits.groupBy("feature", "number", "weight").agg(
        F.min(F.struct("upper", "value")).alias("lo"), F.max(F.struct("upper", "value")).alias("hi")
    )
    low, high = F.col("lo.value"), F.col("hi.value")
    value = low + (high - low) * F.col("weight")
    exact = ends.groupBy("feature").agg(
        *[F.max(F.when(F.col("number") == i, value)).alias(f"q{i}") for i in range(len(probabilities))]
    )
    joined = known.join(F.broadcast(exact), "feature", "left")
    return joined.withColumn("feature", feature_names(columns))


def _wanted_ranks(known: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Per feature and probability the whole ranks around its position and the weight of the upper one."""
    shares = F.array(*[F.lit(float(p)) for p in probabilities])
    placed = known.select("feature", F.posexplode(shares).alias("number", "share"), "n").withColumn(
        "position", F.col("share") * (F.col("n") - 1)
    )
    ranks = F.array_distinct(F.array(F.floor("position"), F.ceil("position")))
    weight = (F.col("position") - F.floor("position")).alias("weight")
    return placed.select("feature", "number", weight, F.posexplode(ranks).alias("upper", "rank"))
