"""Quality rules: base measures of a text, and a likelihood ratio against a trusted target.

The ratio is that of two multinomials over hashed words and word pairs: one counted on trusted
documents, one on the whole raw corpus. A document's score is its mean log ratio per word or pair,
and it is kept if the score reaches a fixed threshold and no base rule fails. Counts are sums per
hash bucket (combined before the shuffle); the table of log ratios has a fixed number of entries,
so it reaches the executors as a constant of the plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import SPACES, words

BITS = 16  # buckets of words, and as many of word pairs
THRESHOLD = -0.17  # natural log per word or pair
TRUSTED = 100_000  # most trusted documents that the target is counted on


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """Ids of documents labelled good: at most ``most``, those with the smallest hash of the id."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _pick(array: Column, i: Column) -> Column:
    return F.get(array, i)


def hashes(words_: Column) -> Column:
    return F.transform(words_, lambda w: F.xxhash64(w))


def pair_hashes(h: Column) -> Column:
    """Hashes of all pairs of neighbours."""
    n = F.greatest(F.size(h) - 1, F.lit(0))
    return F.zip_with(F.slice(h, 1, n), F.slice(h, 2, n), lambda a, b: F.xxhash64(a, b))


def _bucket(x: Column, bits: int) -> Column:
    return F.shiftrightunsigned(x, 64 - bits).cast("int")


def bucket_counts(docs: DataFrame, trusted: DataFrame, bits: int = BITS) -> DataFrame:
    """bucket, raw (over all documents) and target (over trusted ones)."""
    marked = trusted.select(F.col("doc_id").alias("_id"), F.lit(1).alias("_trusted"))
    # at most TRUSTED ids
    rows = docs.select("doc_id", "text").join(F.broadcast(marked), F.col("doc_id") == F.col("_id"), "left")
    hashed = rows.select("_trusted", hashes(words(F.col("text"))).alias("_h"))
    pairs = hashed.select("_trusted", "_h", pair_hashes(F.col("_h")).alias("_p"))
    # words, then pairs
    both = pairs.select("_trusted", F.posexplode(F.array("_h", "_p")).alias("part", "hashes"))
    grams = both.select("_trusted", "part", F.explode("hashes").alias("hash"))
    bucket = _bucket(F.col("hash"), bits) + F.col("part") * (1 << bits)
    return grams.select("_trusted", bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("target"))


def log_ratios(counts: DataFrame, bits: int = BITS, prior: float = 5.0) -> tuple[Column, Column]:
    """The tables of log ratios of words and of pairs as array constants; zeros without trusted documents.

    A bucket's target count is shrunk towards what the raw corpus lets expect, by ``prior``
    counts, so a bucket that is rare in both has a ratio near 1.
    """
    n = 2 << bits
    raw, target = [0] * n, [0] * n
    for r in counts.collect():  # at most n rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not any(target):
        return F.array_repeat(F.lit(0.0), n // 2), F.array_repeat(F.lit(0.0), n // 2)
    share = sum(target) / sum(raw)
    ratios = [repr(math.log((t + prior) / (r * share + prior))) for r, t in zip(raw, target)]
    halves = (ratios[: n // 2], ratios[n // 2 :])
    return tuple(F.from_json(F.lit("[" + ",".join(x) + "]"), "array<double>") for x in halves)


def triple_hashes(h: Column, pairs: Column) -> Column:
    """Hashes of all 3-word windows."""
    n = F.greatest(F.size(h) - 2, F.lit(0))
    return F.zip_with(F.slice(pairs, 1, n), F.slice(h, 3, n), lambda ab, c: F.xxhash64(ab, c))


def ordered_windows(triples: Column) -> Column:
    """All windows as (hash, start) in hash order; none where no window occurs twice."""
    again = F.size(F.array_distinct(triples)) < F.size(triples)
    looked_at = F.when(again, triples).otherwise(F.slice(triples, 1, 0))
    return F.sort_array(F.transform(looked_at, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))


def repeated_starts(ordered: str) -> Column:
    """Sorted starts of the windows in column ``ordered`` that equal one of their neighbours."""
    windows = F.col(ordered)
    same = F.transform(
        windows,
        lambda x, i: F.when(
            F.coalesce(_pick(windows, i - 1)["t"] == x["t"], F.lit(False))
            | F.coalesce(_pick(windows, i + 1)["t"] == x["t"], F.lit(False)),
            x["i"],
        ),
    )
    return F.sort_array(F.array_compact(same))


def base_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with _h and _p (hashes of words and pairs) and the base columns, each computed once per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("_h", hashes(words(text)))
    rows = rows.withColumn("_p", pair_hashes(F.col("_h")))
    rows = rows.withColumn("_t", triple_hashes(F.col("_h"), F.col("_p")))
    rows = rows.withColumns(
        {
            "n_words": F.size("_h").cast("long"),
            "word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
            "_lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "_windows": ordered_windows(F.col("_t")),
        }
    )
    # a column that a lambda reads is computed before, else it would be computed per element
    rows = rows.withColumn("_starts", repeated_starts("_windows"))
    rows = rows.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.aggregate(
                F.transform(
                    "_starts",
                    lambda x, i: F.least(F.lit(3), F.coalesce(_pick(F.col("_starts"), i + 1) - x, F.lit(3))),
                ),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            ),
        }
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).drop("_lines", "_windows", "_starts", "_t")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BITS, most: int = TRUSTED) -> DataFrame:
    """``docs`` with the base columns, _score and kept.

    NULL and empty texts have no words and fail the base rules. Without trusted documents every
    score is 0, so only the base rules decide. Repeated rows are judged alike.
    """
    of_word, of_pair = log_ratios(bucket_counts(docs, trusted_ids(labels, most), bits), bits)
    rows = base_measures(docs)
    total = F.aggregate("_h", F.lit(0.0), lambda a, x: a + _pick(of_word, _bucket(x, bits)))
    total = total + F.aggregate("_p", F.lit(0.0), lambda a, x: a + _pick(of_pair, _bucket(x, bits)))
    count = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    rows = rows.withColumn("_score", total / count)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("_score") >= threshold)).drop("_h", "_p")


def rule_digest(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    rows = judged(docs.select("doc_id", "text"), labels, **options)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("_score", 6).alias("score"),
    )


def passing(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns."""
    rows = judged(docs.select(F.struct("*").alias("_doc"), "doc_id", "text"), labels, **options)
    # not a filter: that would be moved below the measures and repeat them inside its lambdas
    kept = rows.select(F.explode(F.when(F.col("kept"), F.array("_doc"))).alias("_doc"))
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
