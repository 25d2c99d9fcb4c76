"""Fill-in-the-middle transformation of whole documents.

A text is cut into units (``UNIT``: white space glued to the word after it, or white space at the
end). The code point offsets where units end form a boundary set kept in Roaring style: the
offsets are split by their high 16 bits into containers, each stored as a sorted array, a bitmap
or a list of runs, whichever is smallest, with the cumulative cardinality of all containers before
it. The offset after the k-th unit is found by a binary search over those cardinalities for the
container, then a select inside it; both cut offsets come from one call.

Cut points and form follow from the SHA-256 of ``SEED:`` and the decimal ``doc_id``: the first
four 8-digit hex groups h1 to h4 as unsigned integers. With n units, the prefix ends after
min(h1 % (n+1), h2 % (n+1)) units and the middle after the max. The text stays plain if it is
empty, holds a marker, or h3 % 100 >= PLAIN_FROM; otherwise it becomes SPM if h4 % 100 < SPM_BELOW,
else PSM.

Edge rows: a NULL text counts as empty (n = 0, plain, output ''); a NULL doc_id hashes ``SEED:``
alone; a text of white space only is one unit; repeated rows get equal outputs; the very longest
texts are cut whole, as every text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the contract: seed, markers, shares.
SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 50, 80
#: a unit: white space, then a word; or white space at the end
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

#: containers of more values than this are bitmaps (as in Roaring: 4096 two-byte values = 8 KB)
ARRAY_MOST = 4096
_WHITE = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], np.uint32)
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BYTE_COUNT = _BYTE_BITS.sum(1)

OUTPUT = ("n", "form", "prefix_chars", "middle_chars", "fim_text")


class BoundarySet:
    """A set of non-negative offsets in Roaring-style containers with cumulative cardinalities."""

    __slots__ = ("keys", "kinds", "parts", "cumulative")

    def __init__(self, offsets: np.ndarray):
        values = np.unique(np.asarray(offsets, dtype=np.int64))
        high, low = values >> 16, (values & 0xFFFF).astype(np.uint16)
        self.keys, starts = np.unique(high, return_index=True)
        bounds = np.append(starts, len(values))
        self.kinds, self.parts = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            kind, part = self._container(low[a:b])
            self.kinds.append(kind)
            self.parts.append(part)
        self.cumulative = np.cumsum(np.diff(bounds)) if len(values) else np.zeros(0, np.int64)

    @staticmethod
    def _container(low: np.ndarray) -> tuple[str, object]:
        """The smallest of array (2 bytes a value, at most ARRAY_MOST), bitmap (8 KB) and runs (4 bytes a run)."""
        breaks = np.flatnonzero(np.diff(low.astype(np.int32)) != 1) + 1
        run_starts = np.concatenate([[0], breaks])
        sizes = {"array": 2 * len(low) if len(low) <= ARRAY_MOST else 1 << 20, "run": 4 * len(run_starts), "bitmap": 8192}
        kind = min(sizes, key=sizes.get)
        if kind == "array":
            return kind, low
        if kind == "run":
            return kind, (low[run_starts].astype(np.int64), np.cumsum(np.diff(np.append(run_starts, len(low)))))
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        packed = np.packbits(bits, bitorder="little")
        return kind, (packed, np.cumsum(_BYTE_COUNT[packed]))

    def __len__(self) -> int:
        return int(self.cumulative[-1]) if len(self.cumulative) else 0

    def select(self, rank: int) -> int:
        """The value of 0-based ``rank`` in ascending order."""
        i = int(np.searchsorted(self.cumulative, rank, side="right"))
        local = rank - (int(self.cumulative[i - 1]) if i else 0)
        kind, part = self.kinds[i], self.parts[i]
        if kind == "array":
            low = int(part[local])
        elif kind == "run":
            starts, ends = part
            r = int(np.searchsorted(ends, local, side="right"))
            low = int(starts[r]) + local - (int(ends[r - 1]) if r else 0)
        else:
            packed, counts = part
            byte = int(np.searchsorted(counts, local, side="right"))
            inside = local - (int(counts[byte - 1]) if byte else 0)
            low = 8 * byte + int(np.flatnonzero(_BYTE_BITS[packed[byte]])[inside])
        return (int(self.keys[i]) << 16) | low

    def cuts(self, first: int, second: int) -> tuple[int, int]:
        """Offsets after ``first`` and ``second`` units (0 after none)."""
        return tuple(self.select(k - 1) if k else 0 for k in (first, second))


def unit_ends(text: str) -> np.ndarray:
    """Code point offsets where the units of ``text`` end."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64)
    white = np.isin(points, _WHITE)
    word_end = ~white & np.append(white[1:], True)
    ends = np.flatnonzero(word_end) + 1
    if white[-1]:
        ends = np.append(ends, len(points))
    return ends


def digests(doc_id) -> tuple[int, int, int, int]:
    """h1 to h4 of a document."""
    key = f"{SEED}:{'' if doc_id is None else int(doc_id)}".encode()
    hexed = hashlib.sha256(key).hexdigest()
    return tuple(int(hexed[8 * j : 8 * j + 8], 16) for j in range(4))


def transform(doc_id, text) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    text = text or ""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = digests(doc_id)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    a, b = h1 % (n + 1), h2 % (n + 1)
    first, second = BoundarySet(ends).cuts(min(a, b), max(a, b))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and fim_text (the training text).

    All input columns pass through, except input columns named like the five new ones, which
    are replaced. Rows stay where they are: no shuffle.
    """
    kept = [c for c in docs.columns if c not in OUTPUT]
    base = docs.select(*kept)
    added = pa.schema(
        [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("fim_text", pa.string())]
    )
    schema = T.StructType(
        [
            *base.schema.fields,
            *(T.StructField(c, T.LongType() if c in ("n", "prefix_chars", "middle_chars") else T.StringType()) for c in OUTPUT),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*(transform(i, t) for i, t in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist())))) or [[]] * 5
            columns = [pa.array(values, field.type) for values, field in zip(made, added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *OUTPUT])

    return base.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The original text from a FIM output and its form (JVM only)."""
    parts = F.split(output, "<P>|<S>|<M>")
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
    )


def fim_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 per row."""
    out = fill_in_middle(docs.select("doc_id", "text"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim_text"), F.col("form")), 256).alias("restored_sha256"),
    )
