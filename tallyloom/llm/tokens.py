"""Numpy kernels over the bytes of many texts at once, for Arrow batches inside tasks.

Texts are worked on in blocks of whole documents (about two million bytes, or one document where
it is longer), so memory follows the block, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21

_ALL = np.arange(256, dtype=np.uint8)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
SPACE = np.isin(_ALL, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: bytes of words that are runs of anything but white space
NOT_SPACE = ~SPACE
#: bytes of words that are runs of digits, lower-case letters and everything beyond ASCII
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of whole texts; NULL counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, whole[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def spans(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of the first word of every text (one more at the end)."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    mask = inside[buf]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    filled = offsets[:-1][np.diff(offsets) > 0]
    first[filled] = mask[filled]
    closed = offsets[1:][np.diff(offsets) > 0] - 1
    last[closed] = mask[closed]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, BLOCK + 1)
        up = np.full(n, _P, dtype=np.uint64)
        down = np.full(n, _P_INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _powers, _inverse = np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: a polynomial in its bytes, from running sums modulo 2**64."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _grow(len(buf) + 1)
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _powers[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverse[starts])


def hash_of(words: list[str]) -> np.ndarray:
    """The same hash for single words."""
    data = [w.encode() for w in words]
    lengths = np.array([len(d) for d in data], dtype=np.int64)
    ends = np.cumsum(lengths)
    return word_hashes(np.frombuffer(b"".join(data), dtype=np.uint8), ends - lengths, ends)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words per text (of the whole text where it is shorter), and offsets."""
    count = np.diff(first)
    full = np.zeros(len(h), dtype=np.uint64)
    n = max(len(h) - k + 1, 0)
    for j in range(k):
        full[:n] = mix(full[:n] ^ h[j : j + n]) + np.uint64(j + 1)
    place = np.arange(len(h)) - np.repeat(first[:-1], count)
    keep = place + k <= np.repeat(count, count)
    for d in np.flatnonzero((count > 0) & (count < k)):
        value = np.zeros(1, np.uint64)
        for j in range(count[d]):
            value = mix(value ^ h[first[d] + j : first[d] + j + 1]) + np.uint64(j + 1)
        full[first[d]], keep[first[d]] = mix(value + np.uint64(count[d]))[0], True
    sizes = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    return full[keep], np.concatenate([[0], np.cumsum(sizes)])


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every text, and offsets."""
    out, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    for d in range(len(offsets) - 1):
        v = np.sort(values[offsets[d] : offsets[d + 1]])
        if len(v):
            v = v[np.concatenate([[True], v[1:] != v[:-1]])]
            sizes[d] = len(v)
            out.append(v)
    joined = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return joined, np.concatenate([[0], np.cumsum(sizes)])
