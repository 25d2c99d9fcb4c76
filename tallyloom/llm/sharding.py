"""Histogram sort: shards of near equal bytes from exact counts below candidate boundaries.

Sort key of a row: 60 bits of the MD5 of its text, then 60 bits of the MD5 of its id, so equal
texts are neighbours. Passes over the narrow key table count bytes and rows per bucket of the next
12 key bits, only where a boundary still lies; the driver gets at most 4096 sums per boundary and
pass. A shard boundary is the end of the group of equal texts that is nearest to its share of the
bytes. Where that is off by more than ``group_tolerance`` of a shard, as with a group that is
larger than a shard, the nearest end of a single id within the group is taken. Rows are then
exchanged once, into key ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.positions import positions
from tallyloom.llm.words import hex_number
from tallyloom.sources.staging import stage

BITS, STEP = 60, 12


@dataclass
class Probe:
    """The search for one boundary: the bucket of ``key`` with ``prefix`` (``bits`` long) holds it."""

    target: int  # bytes below the boundary, times the number of shards
    prefix: int = 0
    bits: int = 0
    before: int = 0
    ends: tuple = ()  # candidate boundaries seen: (bytes below, last key)
    done: bool = False


def _search(keys: DataFrame, column: str, targets: list[int], shards: int, start: int, low: Column | None = None) -> list[list[tuple[int, int]]]:
    """For each target the candidate ends around it: (bytes up to the end, last key value below it).

    ``start``: bytes before all of ``keys``. Both neighbours of a target are always among them.
    """
    probes = [Probe(t, before=start, ends=((start, -1),)) for t in targets]
    bits = 0
    while bits < BITS and not all(p.done for p in probes):
        wanted = sorted({p.prefix for p in probes if not p.done})
        high = F.shiftright(column, BITS - bits)
        rows = (
            keys.where(high.isin(wanted))
            .groupBy(F.shiftright(column, BITS - bits - STEP).alias("bucket"))
            .agg(F.sum("size").alias("bytes"), F.min(column).alias("least"), F.max(column).alias("most"))
            .orderBy("bucket")
            .collect()
        )
        inside: dict[int, list] = {}
        for r in rows:
            inside.setdefault(r["bucket"] >> STEP, []).append(r)
        for p in probes:
            if p.done:
                continue
            below = p.before
            for r in inside.get(p.prefix, []):
                if (below + r["bytes"]) * shards >= p.target:
                    p.ends += ((below + r["bytes"], r["most"]),)
                    p.prefix, p.before, p.done = r["bucket"], below, r["least"] == r["most"]
                    break
                below += r["bytes"]
                p.ends += ((below, r["most"]),)
            else:
                p.done = True
        bits += STEP
    return [list(p.ends) for p in probes]


def _nearest(ends: list[tuple[int, int]], target: int, shards: int) -> tuple[int, int]:
    return min(ends, key=lambda e: (abs(e[0] * shards - target), e[0]))


def splitters(keys: DataFrame, shards: int, group_tolerance: float) -> list[tuple[int, int]]:
    """The last (text_key, id_key) of every shard but the last; ``keys`` has text_key, id_key, size."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = [k * total for k in range(1, shards)]
    found = []
    for target, ends in zip(targets, _search(keys, "text_key", targets, shards, 0)):
        near, key = _nearest(ends, target, shards)
        if abs(near * shards - target) > group_tolerance * total:
            # the target lies inside one group of equal texts
            below, end = max(e for e in ends if e[0] * shards < target), min(e for e in ends if e[0] * shards >= target)
            inner = _search(keys.where(F.col("text_key") == end[1]), "id_key", [target], shards, below[0])[0]
            near, id_key = _nearest(inner, target, shards)
            found.append((end[1], id_key))
        else:
            found.append((key, (1 << BITS)))
    return found


def shard_of(bounds: list[tuple[int, int]]) -> Column:
    """Number of boundaries below the row's key."""
    after = [
        ((F.col("text_key") > t) | ((F.col("text_key") == t) & (F.col("id_key") > i))).cast("int") for t, i in bounds
    ]
    total = F.lit(0)
    for a in after:
        total = total + a
    return total


def with_keys(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {
            "size": (F.octet_length(text) + 8).cast("long"),
            "text_crc32": F.crc32(text),
            "text_key": hex_number(text, 15),
            "id_key": hex_number(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 15),
        }
    )


def shard_rows(docs: DataFrame, shards: int = 24, group_tolerance: float = 0.02) -> DataFrame:
    """Digest of the shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A NULL text counts as empty, a NULL id has a key of its own, repeated rows get slots of their
    own, no rows give no rows. Slots follow the sort key within a shard.
    """
    keys = stage(with_keys(docs.select("doc_id", "text")).drop("text"), "shard-keys")
    bounds = splitters(keys, shards, group_tolerance)
    placed = positions(
        keys.withColumn("shard", shard_of(bounds)), [F.col("text_key").asc(), F.col("id_key").asc()], "shard", "slot"
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
