"""An FM-index over a sequence of symbols: suffix array, BWT, wavelet tree, backward search.

All steps work on whole arrays; many patterns are searched at once.
"""

from __future__ import annotations

import numpy as np


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys (stable) and their dense ranks."""
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=new[1:])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, rank


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling; a shorter suffix sorts before its
    extensions. Once ranks are set, only suffixes that still share a rank are ordered again."""
    n = len(symbols)
    order, rank = _dense(symbols.astype(np.int64))
    step = 1
    while n:
        counts = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(counts[rank] > 1)
        if not len(open_):
            break
        # ranks with gaps: the first place of each group
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        follow = open_ + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        within, _ = _dense(rank[open_] * (n + 1) + second)
        chosen, pairs = open_[within], (rank[open_] * (n + 1) + second)[within]
        new = np.concatenate([[False], pairs[1:] != pairs[:-1]])
        group = np.concatenate([[True], rank[chosen][1:] != rank[chosen][:-1]])
        # place inside the group: rank of the group's start plus members before
        index = np.arange(len(chosen))
        start = np.maximum.accumulate(np.where(group, index, 0))
        lead = np.maximum.accumulate(np.where(new | group, index, 0))
        place = first[rank]
        place[chosen] = first[rank[chosen]] + lead - start
        _, rank = _dense(place)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class WaveletTree:
    """Ranks of symbols in a sequence, one bit vector per bit of a symbol (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.zeros, self.ones = [], []
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(at), at.copy()
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> b) & 1).astype(bool)
            ones, zeros = self.ones[level], self.zeros[level]
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            one = ones[at + 1] - ones[at]
            symbol = symbol * 2 + one
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return symbol


class FMIndex:
    """Index of ``symbols`` (numbers from 1; 0 ends the sequence) with every ``sample``-th position kept."""

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        text = np.concatenate([symbols.astype(np.int64), [0]])
        order = suffix_array(text)
        bwt = text[order - 1]
        bits = max(int(text.max()).bit_length(), 1)
        self.tree = WaveletTree(bwt, bits)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        self.size, self.sample = len(text), sample
        self.marked = order % sample == 0
        self.kept = order[self.marked]
        self.kept_rank = np.concatenate([[0], np.cumsum(self.marked)])

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges [low, high) of the suffixes that start with each pattern (rows, padded on the right)."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.size, np.int64)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - back].astype(np.int64)
            known = symbol < len(self.before) - 1
            symbol = np.where(known, symbol, 0)
            base = self.before[symbol]
            low[live] = base + self.tree.rank(symbol, low[live])
            high[live] = np.where(known, base + self.tree.rank(symbol, high[live]), low[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back until a kept position."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.marked[at])
        while len(walking):
            symbol = self.tree.access(at[walking])
            at[walking] = self.before[symbol] + self.tree.rank(symbol, at[walking])
            steps[walking] += 1
            walking = walking[~self.marked[at[walking]]]
        return self.kept[self.kept_rank[at]] + steps
