"""SimHash near copies against a brute force over all pairs."""

from __future__ import annotations

import re

import xxhash

from tallyloom.llm import simhash
from tests.llm.conftest import EDGES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum((h >> j) & 1 for h in hs) > len(hs))


def brute(rows):
    """doc_id -> (hex, component_id) by all pairs and a union-find."""
    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = d if r not in least else min(least[r], d)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=order)


def order(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row)


def ours(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in simhash.near_copies(docs).collect()), key=order)


def flipped(text, k):
    words = text.split()
    return " ".join(w + "x" if i % 97 == k else w for i, w in enumerate(words))


def test_masks_cover_every_split():
    probes, targets = set(simhash.PROBES), set(simhash.TARGETS)
    assert len(probes) == 65 and len(targets) == 65 + 992
    for a in range(64):
        for b in range(a + 1, 64):
            for c in range(b + 1, 64):
                m = {a, b, c}
                assert any(simhash._flip((x,)) in probes and simhash._flip(tuple(sorted(m - {x}))) in targets for x in m)


def test_fixture_equals_brute_force(spark, tiny_rows):
    base = [t for _, t in tiny_rows if t and len(t.split()) > 300][:5]
    planted = [(10_000 + 10 * i + k, flipped(t, k)) for i, t in enumerate(base) for k in range(4)]
    rows = tiny_rows + planted + [(20_000, base[0]), (20_001, base[0])]
    want = brute(rows)
    assert ours(spark, rows) == want
    assert len({c for _, _, c in want}) < len(want)  # some links exist


def test_edges_equal_brute_force(spark):
    rows = [(d, t) for d, t, *_ in EDGES] + [(12, "   "), (13, "ONE two"), (14, "one TWO")]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, []) == []


def test_zero_fingerprint_links_like_any_other(spark):
    out = dict((d, (f, c)) for d, f, c in ours(spark, [(3, None), (4, ""), (5, "\t")]))
    assert out == {3: ("0" * 16, 3), 4: ("0" * 16, 3), 5: ("0" * 16, 3)}


def test_slices_hold_every_target_mask_once():
    dealt = [m for i in range(simhash.SLICES) for m in simhash.TARGETS[i :: simhash.SLICES]]
    assert sorted(dealt) == sorted(simhash.TARGETS)
    # a slice shuffles a bounded part of all targets
    assert max(len(simhash.TARGETS[i :: simhash.SLICES]) for i in range(simhash.SLICES)) < len(simhash.TARGETS) / 4
