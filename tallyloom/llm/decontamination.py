"""Benchmark decontamination: an FM-index per training shard, searched for benchmark windows.

A shard is a run of documents inside a task. A benchmark window can only lie inside a run of words
that all occur in the benchmark and that is as long as the shortest window, so the index holds
exactly those runs, each closed by a separator. All windows are searched backwards at once, their
places come from sampled suffix positions and are mapped back to words of documents, where
overlapping places merge. Nothing is shuffled.

The benchmark reaches the tasks in blocks of items with at most ``BLOCK_BYTES`` of text; more
blocks mean more passes over the documents, whose places so far travel along.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm import tokens
from tallyloom.llm.fm_index import FMIndex
from tallyloom.sources.staging import stage

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 19

_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


class Phrases:
    """The windows of a block of benchmark items, as numbers of their words."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        owners: dict[tuple, set] = defaultdict(set)
        for item, text in items:
            words = _WORDS.findall((text or "").translate(_LOWER))
            for at in range(max(len(words) - window + 1, min(len(words), 1))):
                owners[tuple(words[at : at + window])].add(item)
        vocabulary = sorted({w for phrase in owners for w in phrase})
        number = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.hashes = tokens.hash_of(vocabulary)
        order = np.argsort(self.hashes)
        self.hashes, self.numbers = self.hashes[order], order + 1
        self.separator = len(vocabulary) + 1
        self.owners = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.patterns = np.zeros((len(owners), window), np.int64)
        for i, phrase in enumerate(owners):
            self.patterns[i, : len(phrase)] = [number[w] for w in phrase]
        self.least = int(self.lengths.min(initial=window))

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers of hashes, 0 for words that no window has."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], 0)


def _runs(numbers: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """Places of words inside runs of known words, within one text, of ``least`` words or more."""
    known = numbers > 0
    start = known.copy()
    start[1:] &= ~known[:-1]
    begins = first[:-1][np.diff(first) > 0]
    start[begins] = known[begins]
    run = np.cumsum(start) - 1
    places = np.flatnonzero(known)
    return places[np.bincount(run[places])[run[places]] >= least] if len(places) else places


def _shard(numbers: np.ndarray, first: np.ndarray, phrases: Phrases) -> list[tuple[int, int, int]]:
    """(text, first word in it, window) of all occurrences in a shard."""
    places = _runs(numbers, first, phrases.least)
    if not len(places):
        return []
    text = np.searchsorted(first, places, side="right") - 1
    gap = np.flatnonzero((np.diff(places) > 1) | (np.diff(text) > 0)) + 1
    symbols = np.insert(numbers[places], gap, phrases.separator)
    origin = np.insert(places, gap, -1)
    index = FMIndex(symbols)
    low, high = index.search(phrases.patterns, phrases.lengths)
    count = high - low
    total = int(count.sum())
    if not total:
        return []
    window = np.repeat(np.arange(len(count)), count)
    rows = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    word = origin[index.locate(rows)]
    text = np.searchsorted(first, word, side="right") - 1
    return list(zip(text.tolist(), (word - first[text]).tolist(), window.tolist()))


def _search(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """Adds the places and items of one block of phrases to the rows of ``docs`` (doc_id, text, n_words, starts, ends, items)."""
    sent = docs.sparkSession.sparkContext.broadcast(phrases)  # bounded by BLOCK_BYTES

    def run(batches):
        phrases = sent.value
        for batch in batches:
            found = [([], [], set()) for _ in range(batch.num_rows)]
            counts = np.zeros(batch.num_rows, np.int64)
            shard, offset, size = [], 0, 0

            def close():
                numbers = np.concatenate([x for x, _, _ in shard])
                first, shift = [np.zeros(1, np.int64)], 0
                for x, f, _ in shard:
                    first.append(f[1:] + shift)
                    shift += len(x)
                for text, at, window in _shard(numbers, np.concatenate(first), phrases):
                    starts, ends, items = found[shard[0][2] + text]
                    starts.append(at)
                    ends.append(at + int(phrases.lengths[window]))
                    items.update(phrases.owners[window])

            for at, _, buf, offsets in tokens.blocks(batch.column("text")):
                buf = tokens.LOWER[buf]
                starts, ends, first = tokens.spans(buf, offsets, tokens.ALNUM)
                counts[at : at + len(first) - 1] = np.diff(first)
                shard.append((phrases.numbered(tokens.word_hashes(buf, starts, ends)), first, at))
                size += len(starts)
                if size >= SHARD_WORDS:
                    close()
                    shard, size = [], 0
            if shard:
                close()
            old = {c: batch.column(c).to_pylist() for c in ("starts", "ends", "items")}
            merged = [_merge(a + x, b + y) for a, b, (x, y, _) in zip(old["starts"], old["ends"], found)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array(counts),
                    pa.array([m[0] for m in merged], pa.list_(pa.int64())),
                    pa.array([m[1] for m in merged], pa.list_(pa.int64())),
                    pa.array([sorted(x[2].union(i)) for i, x in zip(old["items"], found)], pa.list_(pa.string())),
                ],
                names=["doc_id", "text", "n_words", "starts", "ends", "items"],
            )

    return docs.mapInArrow(run, docs.schema)


def _merge(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Overlapping and touching places as one."""
    out: tuple[list[int], list[int]] = ([], [])
    for s, e in sorted(zip(starts, ends)):
        if out[0] and s <= out[1][-1]:
            out[1][-1] = max(out[1][-1], e)
        else:
            out[0].append(s)
            out[1].append(e)
    return out


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text, n_words, starts and ends of merged places (word numbers), items (sorted strings).

    A NULL text has no words. Benchmark rows without id or without words match nothing; rows that
    share an id are one item; an item with fewer words than a window is one window. Repeated
    documents are judged each. No documents give no rows, no benchmark gives no places.
    """
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    if n > 1:
        items = stage(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark")
    empty = "array<bigint>"
    rows = docs.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast(empty).alias("starts"),
        F.array().cast(empty).alias("ends"), F.array().cast("array<string>").alias("items"),
    )
    for b in range(n):
        block = items.where(F.col("block") == b) if n > 1 else items
        phrases = Phrases([(r["item_id"], r["text"]) for r in block.select("item_id", "text").toLocalIterator()], window)
        rows = _search(rows, phrases)
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of ``docs``."""
    rows = contaminated_spans(docs, benchmark, **options)
    lengths = F.zip_with("ends", "starts", lambda e, s: e - s)
    hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with their own columns."""
    # the text travels once
    rest = F.struct(F.lit(0).alias("__filled"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = contaminated_spans(docs.select(rest.alias("doc_id"), "text"), benchmark, **options)
    columns = [F.col(c) if c == "text" else F.col(f"doc_id.`{c}`").alias(c) for c in docs.columns]
    return rows.where(F.size("starts") == 0).select(*columns)


@F.pandas_udf(T.StringType())
def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    """Texts without the words of the places; what stood before the first word after a cut stays."""

    def one(text, begin, end):
        if text is None or not len(begin):
            return text
        words = [m.span() for m in _WORDS.finditer(text.translate(_LOWER))]
        parts, at = [], 0
        for b, e in zip(begin, end):
            parts.append(text[at : words[b][0]])
            at = words[e - 1][1]
        return "".join([*parts, text[at:]])

    return pd.Series([one(*row) for row in zip(texts, starts, ends)])
