"""Fill-in-the-middle: boundary sets against sorted arrays, round trips, edge rows, SQL."""

from __future__ import annotations

import re

import numpy as np
import pytest

from tallyloom.llm import fill_in_middle as fim
from tests.compare import differences, duck, rows_of_duck, rows_of_spark
from tests.llm.conftest import EDGES
from tallyloom.llm.oracle import ORACLE

UNIT = re.compile(fim.UNIT)


@pytest.mark.parametrize(
    "values",
    [
        np.arange(0, 200_000, 7),  # arrays over several containers
        np.arange(65_536, 65_536 + 30_000),  # one run
        np.random.default_rng(1).choice(300_000, 60_000, replace=False),  # bitmaps
        np.array([5]),
        np.concatenate([np.arange(10, 20), np.arange(70_000, 70_003), np.arange(140_000, 150_000, 2)]),
    ],
)
def test_select_equals_sorted_array(values):
    s = fim.BoundarySet(values)
    want = np.unique(values)
    assert len(s) == len(want)
    assert {*s.kinds} <= {"array", "bitmap", "run"}
    for rank in {0, len(want) - 1, len(want) // 2, *np.random.default_rng(2).integers(0, len(want), 200).tolist()}:
        assert s.select(rank) == want[rank]


def test_all_container_kinds_are_used():
    kinds = set()
    for v in (np.arange(0, 100, 3), np.arange(0, 50_000), np.random.default_rng(3).choice(65_536, 20_000, replace=False)):
        kinds |= set(fim.BoundarySet(v).kinds)
    assert kinds == {"array", "run", "bitmap"}


def brute(doc_id, text):
    """The contract written out plainly with Python's regex module."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h1, h2, h3, h4 = fim.digests(doc_id)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    k1, k2 = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:k1]), "".join(units[k1:k2]), "".join(units[k2:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return n, ("spm" if h4 % 100 < 80 else "psm"), len(p), len(m), out


def test_transform_equals_brute_force_and_round_trips(tiny_rows):
    rows = tiny_rows + [(i, f" a\tb  c\n\n{i} é😀 ") for i in range(300)] + [(7, "x <M> y"), (None, " lead"), (8, "   ")]
    forms = set()
    for doc_id, text in rows:
        got = fim.transform(doc_id, text)
        assert got == brute(doc_id, text)
        forms.add(got[1])
        n, form, p, m, out = got
        if form != "plain":
            parts = re.split("<P>|<S>|<M>", out)
            back = parts[1] + parts[3] + parts[2] if form == "psm" else parts[2] + parts[3] + parts[1]
            assert back == (text or "")
    assert forms == {"plain", "psm", "spm"}


def test_edges(spark, edges, nothing):
    out = fim.fill_in_middle(edges)
    rows = out.collect()
    assert len(rows) == len(EDGES)
    assert [c for c in out.columns if c in fim.OUTPUT] == list(fim.OUTPUT)
    assert "_doc" in out.columns and "size" in out.columns
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim_text"]) == brute(r["doc_id"], r["text"])
    digest = fim.fim_digest(edges).collect()
    assert all(r["restored_sha256"] == brute_sha(t) for r, (_, t, *_) in zip(sorted(digest, key=key), sorted(EDGES, key=key)))
    assert fim.fim_digest(nothing).count() == 0


def key(row):
    doc_id = row["doc_id"] if hasattr(row, "asDict") else row[0]
    text = None if hasattr(row, "asDict") else row[1]
    return (doc_id is None, doc_id or 0, text is None, text or "")


def brute_sha(text):
    import hashlib

    return hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_sql_on_sf001(spark):
    sf = "/root/testdata/sf0.01"
    from tallyloom.llm.catalog import REGISTRY

    got = rows_of_spark(REGISTRY["op11_fill_in_middle"](spark, sf))
    assert differences(got, rows_of_duck(duck(sf), ORACLE["op11_fill_in_middle"])) == []
