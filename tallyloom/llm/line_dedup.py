"""Cross-site boilerplate lines, by the spread of a line over distinct sites.

Lines are hashed once into a narrow table. A line seen at two sites or more gets a HyperLogLog
sketch of its sites; sketches of salted parts merge by aggregation, so a line that is everywhere is
sketched in many tasks. Where the estimate is near the threshold the sites are counted exactly.
Boilerplate lines are then cut from all texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.staging import stage

MIN_SITES = 6
LOG_BUCKETS = 10
NEAR = 0.15  # share of the threshold that counts as near: over 4 standard errors of the sketch
SALTS = 16
FEW_LINES = 1_000_000  # line hashes that may be broadcast (16 MB)


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(line: Column) -> Column:
    """Hash of the line without white space around it; NULL for a blank line."""
    bare = F.trim(line, F.lit("\t\x0b\x0c\r "))
    return F.when(bare != "", F.xxhash64(bare))


def line_sites(docs: DataFrame, site: str = "source") -> DataFrame:
    """hash and site of every line that is not blank; NULL is a site of its own."""
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"), F.explode(lines(F.col("text"))).alias("line"))
    return rows.select(line_hash(F.col("line")).alias("hash"), "site").where("hash is not null")


def boilerplate(sites: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """hash and its number of sites (a sketch's estimate unless near the threshold)."""
    several = sites.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("site").alias("low"), F.max("site").alias("high"))
    several = stage(several.where((F.col("low") != F.col("high")) & (F.col("n") >= min_sites)).select("hash"), "several")
    rows = sites.join(several, "hash")
    part = rows.groupBy("hash", F.pmod(F.xxhash64("site"), F.lit(SALTS)).alias("salt")).agg(F.hll_sketch_agg("site", F.lit(LOG_BUCKETS)).alias("sketch"))
    spread = stage(
        part.groupBy("hash").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("spread")), "spread"
    )
    low, high = min_sites * (1 - NEAR) - 1, min_sites * (1 + NEAR) + 1
    near = spread.where(F.col("spread").between(low, high)).select("hash")
    exact = rows.join(near, "hash").select("hash", "site").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("spread"))
    sure = spread.where(F.col("spread") > high)
    return sure.unionByName(exact.where(F.col("spread") >= min_sites))


def without_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Columns of ``docs`` with the text cut, and n_lines, n_removed.

    Columns of those names in ``docs`` give way. Every occurrence of a boilerplate line goes; blank lines stay. NULL texts stay NULL. Repeated
    rows are treated each; no rows give no rows. Few boilerplate lines are broadcast, many are
    joined by a shuffle; rows are put together again by a row number, within their own order.
    """
    sites = stage(line_sites(docs, site), "line-sites")
    found = stage(boilerplate(sites, min_sites).select(F.col("hash").alias("_bad")), "boilerplate")
    few = found.count() <= FEW_LINES
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    columns = [c for c in names if c != "text"]
    # numbered before the texts are split
    numbered = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[F.col(f"`{c}`") for c in columns], F.col("text").isNull().alias("_none")).alias("_doc"),
        F.col("text").alias("_text"),
    )
    rows = numbered.select("_row", "_doc", F.posexplode(lines(F.col("_text"))).alias("_at", "_line"))
    marked = rows.join(F.broadcast(found) if few else found, line_hash(F.col("_line")) == F.col("_bad"), "left")
    kept = F.when(F.col("_bad").isNull(), F.struct("_at", "_line"))
    texts = marked.groupBy("_row").agg(
        F.first(F.when(F.col("_at") == 0, F.col("_doc")), ignorenulls=True).alias("_doc"),
        F.collect_list(kept).alias("_kept"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count("_bad").alias("n_removed"),
    )
    text = F.array_join(F.transform(F.array_sort("_kept"), lambda x: x["_line"]), "\n")
    return texts.select(
        *[
            F.when(~F.col("_doc._none"), text).alias(c) if c == "text" else F.col(f"_doc.`{c}`").alias(c)
            for c in names
        ],
        "n_lines",
        "n_removed",
    )
