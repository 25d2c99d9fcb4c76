"""Mixing sources to target weights with thresholds on a hash of each document.

A source's share of the budget is met by taking all its documents a whole number of times and,
once more, those whose 36-bit hash is below a threshold. The threshold comes from sums of words by
source and hash bucket: the bucket where the budget ends is split by the next 12 bits, twice, so
only the rows of boundary buckets are summed again and nothing is sorted. The last unit at the
boundary (one hash value) is taken if at least half of it fits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.positions import positions
from tallyloom.llm.words import hex_number, word_count
from tallyloom.sources.staging import stage

LEVELS, STEP = 3, 12


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """source, source_size and its target; ``share`` (a fraction) of all sizes is dealt by weight.

    Sources by code point, NULL last, take the weights in turn. A target stops at ``most`` times
    the source's size and the excess is dealt again to the others. Each round caps the sources
    that are above; only three sums per round reach the driver. Sums are whole numbers.
    """
    ranked = positions(sizes, [F.col("source").asc_nulls_last()], name="_rank")
    turn = F.array(*[F.lit(w) for w in weights])[(F.col("_rank") % len(weights)).cast("int")]
    table = stage(ranked.withColumn("_weight", turn.cast("long")).drop("_rank"), "sources")
    up, down = share
    total = table.agg(F.sum("source_size")).first()[0] or 0
    num, den, capped = 0, 1, -1
    over = F.lit(False)
    while total:
        rows = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(over, 1)).alias("n"),
        ).first()
        if rows["n"] == capped or not rows["weight"]:
            break
        capped = rows["n"]
        num, den = up * total - down * most * rows["full"], down * rows["weight"]
        over = F.col("_weight").cast("double") * F.lit(float(num)) > F.lit(float(most * den)) * F.col("source_size")
    target = F.when(over, (most * F.col("source_size")).cast("double")).otherwise(
        F.col("_weight").cast("double") * F.lit(float(num)) / F.lit(float(den))
    )
    return table.withColumn("target", target).drop("_weight")


def thresholds(keys: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: copies of every document, and the hash up to which there is one more.

    ``keys``: source, size, hash (36 bits). ``goals``: source, source_size, target.
    """
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("int")
    bounds = goals.withColumn("copies", whole).withColumn("left", F.col("target") - F.col("copies") * F.col("source_size"))
    bounds = bounds.withColumn("prefix", F.lit(0).cast("long"))
    order = Window.partitionBy("source").orderBy("bucket")
    for level in range(LEVELS):
        bits = STEP * (LEVELS - level)
        spans = bounds.select(F.col("source").alias("s"), "prefix", "left", "copies", "source_size", "target")
        rows = keys.join(spans, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", bits) == F.col("prefix")))
        sums = rows.groupBy("source", "left", "copies", "source_size", "target", F.shiftright("hash", bits - STEP).alias("bucket")).agg(
            F.sum("size").alias("n")
        )
        upto = sums.withColumn("upto", F.sum("n").over(order))
        # the first bucket that does not fit as a whole, or the last one
        at = F.min_by(F.struct("bucket", "upto", "n"), F.struct(F.col("upto") <= F.col("left"), F.when(F.col("upto") <= F.col("left"), -F.col("bucket")).otherwise(F.col("bucket"))))
        bounds = stage(
            upto.groupBy("source", "left", "copies", "source_size", "target")
            .agg(at.alias("at"))
            .select(
                "source", "source_size", "target", "copies",
                F.col("at.bucket").alias("prefix"),
                (F.col("left") - F.col("at.upto") + F.col("at.n")).alias("left"),
                F.col("at.n").alias("n"),
            ),
            "bounds",
        )
    below = F.when(2 * F.col("left") >= F.col("n"), F.col("prefix")).otherwise(F.col("prefix") - 1)
    return bounds.select(F.col("source").alias("s"), "source_size", "target", "copies", below.alias("upto"))


def with_hash(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns _size (words) and _hash (36 bits of id and text)."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumns({"_size": word_count(F.col("text")), "_hash": hex_number(key, 9)})


def _plan(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    keys = stage(
        with_hash(docs.select("doc_id", "source", "text")).select("doc_id", "source", F.col("_size").alias("size"), F.col("_hash").alias("hash")),
        "mix-keys",
    )
    sizes = keys.groupBy("source").agg(F.sum("size").alias("source_size"))
    return keys, thresholds(keys, targets(sizes, **options))


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (its words times its copies).

    NULL and empty texts have size 0; a NULL source is a source; rows that are equal in id and
    text are taken alike; no rows give no rows.
    """
    keys, plan = _plan(docs, **options)
    copies = F.col("copies") + (F.col("hash") <= F.col("upto")).cast("int")
    return keys.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, all columns of ``docs``."""
    _, plan = _plan(docs, **options)
    columns = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    rows = with_hash(docs.select(F.struct("*").alias("_doc"), "doc_id", "text", F.col("source").alias("_source"))).drop("doc_id", "text")
    copies = F.col("copies") + (F.col("_hash") <= F.col("upto")).cast("int")
    return (
        rows.join(plan, F.col("_source").eqNullSafe(F.col("s")))
        .where(copies > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        .select(*columns)
    )
