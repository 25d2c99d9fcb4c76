"""Brute-force counterparts of the pipeline operators, on plain Python values."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def fold(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def base_scores(docs):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score)"""
    tokens = {i: [*words(t, True), "\0"] for i, t in docs}
    counts = Counter()
    for i, t in docs:
        if fold(i, 10):
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(x), sum(counts[w] > 0 for w in x), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x))
        for i, x in tokens.items()
    }


def base_measures(text):
    text = text or ""
    w = words(text)
    spots = defaultdict(list)
    for i in range(len(w) - 2):
        spots[tuple(w[i : i + 3])].append(i)
    covered = {p for at in spots.values() if len(at) > 1 for i in at for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def shingle_set(text):
    w = words(text, True)
    return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def components(docs):
    """doc_id -> smallest id reachable over links of all pairs."""
    sets = {i: shingle_set(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = [i for i in sets if sets[i]]
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if 10 * min(len(x), len(y)) < 8 * max(len(x), len(y)):
                continue
            both = len(x & y)
            if 100 * both >= 80 * (len(x) + len(y) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def contamination(docs, benchmark, window=10):
    owners = defaultdict(set)
    for item, text in benchmark:
        w = ALNUM.findall((text or "").translate(LOWER))
        for i in range(max(len(w) - window + 1, min(1, len(w)))):
            owners[tuple(w[i : i + window])].add(str(item))
    out = {}
    for doc, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, items = set(), set()
        for n in {len(x) for x in owners}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in owners:
                    hit.update(range(i, i + n))
                    items |= owners[tuple(w[i : i + n])]
        out[doc] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    return out


def mix_targets(sizes, weights=(5, 2, 1)):
    """source -> target, with fractions."""
    from fractions import Fraction

    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, free, target = Fraction(3, 2) * sum(sizes.values()), set(order), {}
    while free:
        rest = budget - sum(2 * sizes[s] for s in order if s not in free)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | {s: 2 * Fraction(sizes[s]) for s in order if s not in free} | share
        free -= over
    return {s: 2 * Fraction(sizes[s]) for s in order}


def without_lines(docs, min_sites):
    """doc_id -> text; docs are (doc_id, text, site)."""
    sites = defaultdict(set)
    for _, text, site in docs:
        for line in (text or "").split("\n"):
            if line.strip(" \t\x0b\x0c\r"):
                sites[line.strip(" \t\x0b\x0c\r")].add(site)
    bad = {x for x, s in sites.items() if len(s) >= min_sites}
    return {i: None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r") not in bad) for i, t, _ in docs}
