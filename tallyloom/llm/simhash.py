"""SimHash near duplicates by meet-in-the-middle ball hashing.

A document's fingerprint has bit j set when over half of its shingle hashes have bit j set
(shingles: ``SHINGLE`` lower-cased words, repeats counted; a shorter text is one shingle; no words
give fingerprint 0). Two fingerprints link at Hamming distance ``RADIUS`` (3) or less.

Meet in the middle: a pair at distance d <= 3 differs in a set D of bits. One side flips a part of
D, the other side flips the rest, and both land on the same variant. Every distinct fingerprint
emits, as a probe, itself and its 64 one-bit variants (the ball of radius 1, half the radius
rounded down), and, as a target, itself, its 64 one-bit variants and those two-bit variants whose
two bits lie in the same half of the word (992 of the 2016). For every D of at most three bits a
split exists: with three bits, two of them lie in the same half, so the target flips those two
and the probe the third. Probes and targets are shuffled on the variant and joined; pairs are
deduplicated and verified by their distance (every meeting pair is within 1 + 2 = 3 by the
triangle rule, so verification only confirms). Equal fingerprints are one node before the join,
so a group of thousands of copies costs one probe set, not its pairs. The masks of the targets are
dealt to ``SLICES`` joins that run one after the other, each with all probes: together they meet
the same pairs, and only the shuffle of one slice is on disk at a time.

Components: connected over fingerprint links (large-star / small-star steps), then named by the
smallest doc_id in them, itself included.

Edge rows: NULL or empty text and texts without words have fingerprint 0 and link like any
other; a NULL doc_id gets its fingerprint and the component of the smallest non-NULL doc_id it
reaches (NULL if none); repeated rows are separate rows with equal results; extra input columns
are dropped; :func:`fingerprints` returns the columns it is asked to keep and the fingerprint.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.minhash_forest import components
from tallyloom.sources.staging import stage

# Fixed values of the contract: shingle length, hash seed (that of Spark's xxhash64), radius.
SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64

#: joins one after the other, each with its part of the target masks; bounds the disk, not the result
SLICES = 6

_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _flip(bits: tuple[int, ...]) -> int:
    """The signed 64-bit mask with these bits set."""
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


#: probes: itself and one-bit variants; targets: also two-bit variants within one half of the word
PROBES = [0, *(_flip((b,)) for b in range(BITS))]
TARGETS = [
    *PROBES,
    *(_flip((a, b)) for half in (0, BITS // 2) for a in range(half, half + BITS // 2) for b in range(a + 1, half + BITS // 2)),
]


def fingerprint(text: str | None) -> int:
    """The signed 64-bit fingerprint of one text."""
    words = _WORD.findall((text or "").translate(_TO_LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)] or [" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(g.encode(), SEED) for g in grams), np.uint64, len(grams))
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    value = int(np.packbits(2 * ones > len(grams), bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and fingerprint (signed long) per row of ``docs``; no shuffle.

    Shingles are hashed in Arrow batches inside the tasks where the texts lie.
    """
    kept = [c for c in keep if c != "fingerprint"]
    rows = docs.select(*kept, "text")
    schema = T.StructType([*(f for f in rows.schema.fields if f.name in kept), T.StructField("fingerprint", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], prints], names=[*kept, "fingerprint"])

    return rows.mapInArrow(run, schema)


def hex_of(fp: Column) -> Column:
    """16 lower-case hex digits of the unsigned value."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def ball_links(nodes: DataFrame) -> DataFrame:
    """Verified pairs (a, b) of distinct fingerprints within RADIUS, once each, a < b (signed)."""
    probes = nodes.select(F.col("fingerprint").alias("a"), F.explode(F.array(*map(F.lit, PROBES))).alias("_m")).select(
        "a", F.col("a").bitwiseXOR(F.col("_m")).alias("variant")
    )
    links = None
    for i in range(SLICES):
        masks = F.array(*map(F.lit, TARGETS[i::SLICES]))
        targets = nodes.select(F.col("fingerprint").alias("b"), F.explode(masks).alias("_m")).select(
            "b", F.col("b").bitwiseXOR(F.col("_m")).alias("variant")
        )
        met = probes.hint("merge").join(targets, "variant").where("a != b")
        pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        near = stage(pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS), "simhash-links")
        links = near if links is None else links.unionAll(near)
    return links.distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex), component_id per row of ``docs``."""
    printed = stage(fingerprints(docs), "simhash-prints")
    nodes = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("node"))
    nodes = stage(nodes, "simhash-nodes")
    roots = components(ball_links(nodes.select("fingerprint")))
    placed = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "node", F.coalesce("root", "fingerprint").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("node").alias("component_id"))
    placed = placed.join(least, "root").select("fingerprint", "component_id")
    return printed.join(placed, "fingerprint").select("doc_id", hex_of(F.col("fingerprint")).alias("fingerprint"), "component_id")
