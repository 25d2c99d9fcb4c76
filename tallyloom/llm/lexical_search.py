"""Ranked lexical search, term at a time with a limit on accumulators.

Terms are maximal runs of digits, ASCII letters and non-ASCII characters, A-Z lower-cased. With N
documents that hold a term, L terms in all, n terms in a document, df documents holding a term and
tf its count in a document (64-bit integers, division rounding down)::

    w = floor(1000 * ln((2N + 2) / (2 df + 1)))          (in doubles)
    m = 100 - 90 + (90 n N) div L
    score = sum over the query's distinct terms of  w * ((10**9 tf) div (1000 tf + 8 m))

Every query (a ``benchmark`` item) gets its ``TOP`` best documents with a score above 0, equal
scores by ascending doc_id.

Method: for every query its terms are taken rarest first (df, then term). Each term has an exact
bound, w times the largest fraction over its postings. Terms are worked in rounds of growing
blocks of ranks (1, 2-3, 4-7, ...), all queries at once: the postings of the block's terms create
or update accumulators (query, document, partial score). After a round, a query stops creating
accumulators once the bounds of all its remaining terms together are below its TOP-th partial
score (or below 1): a document without an accumulator can then no longer reach its top list. Its
remaining terms then only update the accumulators that exist (a join of the survivors' postings),
exactly. Scores are exact; only the work shrinks.

Edge rows: a NULL text has no terms; a document without terms counts in no N or L and gets no
score; a NULL or empty benchmark text has no terms and no rows; repeated document rows are
separate documents with equal scores and doc_ids (ties among them in any order); NULL doc_ids
come after all others among equal scores; repeated benchmark rows of an item count its terms once.
No rows: an empty result. Only doc_id and text of ``docs``, item_id and text of ``queries`` are
read, so other columns of any name do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.staging import forget, stage

# Fixed values of the contract: the term pattern and the constants of the score.
TERM_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
WEIGHT_SCALE, TF_SCALE, TF_WEIGHT, LENGTH_WEIGHT = 1000, 1_000_000_000, 1000, 8
LENGTH_BASE, LENGTH_SHARE = 100, 90

#: query terms that may be broadcast to the postings' tasks (about 50 MB)
FEW_QUERY_TERMS = 1_000_000
#: salt of the two-level top lists, so that no query's accumulators meet in one task
SALTS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    """The terms of a text, repeats included; NULL has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, TERM_BREAK), lambda t: t != "")


def _sized(df: DataFrame, limit: int = FEW_QUERY_TERMS) -> DataFrame:
    """``df`` broadcast when its counted rows stay within ``limit``."""
    return F.broadcast(df) if df.count() <= limit else df


def _top(scored: DataFrame, key: str, k: int) -> DataFrame:
    """The k best rows of every ``key`` by score, doc_id (NULL last), row; in two levels."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS))
    first = scored.withColumn("_salt", salt).withColumn("_n", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)))
    first = first.where(F.col("_n") <= k).drop("_salt", "_n")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


def postings(docs: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Postings of the query terms (row, doc_id, no, part), term statistics, N and L.

    ``no`` stands for the term: postings hold numbers, the statistics hold the text as well.
    ``part`` is a term's fraction in the document, (10**9 tf) div (1000 tf + 8 m).
    """
    terms = terms_of(F.col("text"))
    stats = docs.agg(F.count(F.when(F.size(terms) > 0, 1)).alias("N"), F.coalesce(F.sum(F.size(terms)), F.lit(0)).alias("L")).first()
    big_n, big_l = int(stats["N"]), int(stats["L"])
    wanted = queries.select(F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    wanted = stage(wanted.withColumn("no", F.monotonically_increasing_id()), "search-query-terms")
    parsed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", terms.alias("terms"))
    parsed = parsed.select("row", "doc_id", F.size("terms").alias("n"), F.explode("terms").alias("term"))
    found = parsed.join(_sized(wanted), "term").drop("term")
    counted = found.groupBy("row", "doc_id", "n", "no").agg(F.count(F.lit(1)).alias("tf"))
    m = F.lit(LENGTH_BASE - LENGTH_SHARE) + F.expr(f"({LENGTH_SHARE}L * n * {big_n}L) div {max(big_l, 1)}L")
    part = F.expr(f"({TF_SCALE}L * tf) div ({TF_WEIGHT} * tf + {LENGTH_WEIGHT} * m)")
    listed = stage(counted.withColumn("m", m).withColumn("part", part).drop("n", "m", "tf"), "search-postings")
    ratio = (F.lit(2.0 * big_n + 2.0)) / (F.lit(2.0) * F.col("df") + F.lit(1.0))
    terms = listed.groupBy("no").agg(F.count(F.lit(1)).alias("df"), F.max("part").alias("most")).join(wanted, "no")
    terms = terms.withColumn("w", F.floor(F.lit(float(WEIGHT_SCALE)) * F.log(ratio)).cast("long"))
    return listed, stage(terms.withColumn("bound", F.col("w") * F.col("most")), "search-term-stats"), big_n, big_l


def search(docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every query."""
    listed, terms, _, _ = postings(docs.select("doc_id", "text"), queries)
    asked = queries.select("item_id", F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    ranked = Window.partitionBy("item_id").orderBy("df", "term")
    after = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    asked = asked.join(terms.select("term", "no", "df", "w", "bound"), "term").withColumn("r", F.row_number().over(ranked))
    asked = stage(asked.withColumn("rest", F.sum("bound").over(after)), "search-asked")
    deepest = asked.agg(F.max("r")).first()[0] or 0
    items = stage(asked.select("item_id").distinct(), "search-items")
    n_items = items.count()

    # creation rounds over blocks of ranks [lo, hi]
    accumulators = None
    stopped = None  # item_id, stop: the first rank that only updates
    lo = 1
    while lo <= deepest:
        hi = 2 * lo - 1
        block = asked.where(F.col("r").between(lo, hi))
        if stopped is not None:
            block = block.join(stopped, "item_id", "left_anti")
        block = block.select("item_id", "no", "w")
        made = listed.join(_sized(block), "no").select("item_id", "row", "doc_id", (F.col("w") * F.col("part")).alias("score"))
        if accumulators is not None:
            made = made.unionByName(accumulators)
        older = accumulators
        accumulators = stage(made.groupBy("item_id", "row", "doc_id").agg(F.sum("score").alias("score")), "search-accumulators")
        forget(older)
        kth = _top(accumulators, "item_id", top).where(F.col("rank") == top).select("item_id", F.col("score").alias("kth"))
        rest = asked.where(F.col("r") == hi + 1).select("item_id", "rest")
        still = items if stopped is None else items.join(stopped, "item_id", "left_anti")
        judged = still.join(rest, "item_id", "left").join(kth, "item_id", "left")
        newly = judged.where(
            F.col("rest").isNull() | (F.col("rest") < F.greatest(F.coalesce("kth", F.lit(0)), F.lit(1)))
        ).select("item_id", F.lit(hi + 1).alias("stop"))
        older = stopped
        stopped = stage(newly if stopped is None else stopped.unionByName(newly), "search-stopped")
        forget(older)
        if stopped.count() == n_items:
            break
        lo = hi + 1

    if accumulators is None:
        return queries.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # update rounds: the remaining terms only add to the accumulators that exist. A survivor meets all
    # postings of its document; the remaining terms are looked up where that is, before any shuffle.
    remaining = asked.join(stopped, "item_id").where(F.col("r") >= F.col("stop")).select("item_id", "no", "w")
    survivors = accumulators.select("item_id", "row")
    updates = (
        survivors.join(listed.select("row", "no", "part"), "row")
        .join(_sized(remaining), ["item_id", "no"])
        .select("item_id", "row", (F.col("w") * F.col("part")).alias("score"))
    )
    updated = updates.groupBy("item_id", "row").agg(F.sum("score").alias("more"))
    final = accumulators.join(updated, ["item_id", "row"], "left").select(
        "item_id", "row", "doc_id", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score")
    )
    best = _top(final.where(F.col("score") > 0), "item_id", top)
    return best.select("item_id", F.col("rank").cast("int"), F.col("doc_id").cast("long"), F.col("score").cast("long"))
