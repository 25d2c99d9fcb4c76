"""Ranked lexical search against exhaustive scoring."""

from __future__ import annotations

import math
import re
from collections import Counter

from tallyloom.llm import lexical_search as ls
from tallyloom.llm.catalog import REGISTRY
from tallyloom.llm.oracle import ORACLE
from tests.compare import differences, duck, rows_of_duck, rows_of_spark
from tests.llm.conftest import EDGES

BREAK = re.compile(ls.TERM_BREAK)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t for t in BREAK.split((text or "").translate(LOWER)) if t]


def brute(docs, queries, top=10):
    """Every document scored for every query, as the contract says it."""
    parsed = [(d, terms(t)) for d, t in docs]
    big_n = sum(1 for _, t in parsed if t)
    big_l = sum(len(t) for _, t in parsed)
    df = Counter(w for _, t in parsed for w in set(t))
    out = []
    for item in sorted({i for i, _ in queries}):
        asked = {w for i, t in queries if i == item for w in terms(t)}
        scored = []
        for k, (d, t) in enumerate(parsed):
            tf, n = Counter(t), len(t)
            m = 100 - 90 + (90 * n * big_n) // max(big_l, 1)
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m)) for w in asked if tf[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, k, d, s))
        for rank, (*_, d, s) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, d, s))
    return out


def ours(spark, docs, queries):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(queries, "item_id long, text string")
    return sorted(tuple(r) for r in ls.search(d, q).collect())


def test_fixture_equals_brute_force(spark, tiny_rows):
    queries = [(1, "the of and"), (2, None), (3, "ZEBRA quux"), (4, tiny_rows[3][1][:400]), (4, "and again"), (5, "")]
    queries += [(10 + i, t[:300]) for i, (_, t) in enumerate(tiny_rows[:20]) if t]
    assert ours(spark, tiny_rows, queries) == sorted(brute(tiny_rows, queries), key=lambda r: (r[0], r[1]))


def test_ties_repeats_and_nulls(spark):
    docs = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (0, "a b c"), (2, "c c c"), (3, None), (4, "")]
    docs += [(100 + i, f"filler{i} words") for i in range(30)]
    queries = [(7, "A b"), (8, "c"), (9, "words")]
    got, want = ours(spark, docs, queries), brute(docs, queries)
    assert [(i, r, s) for i, r, _, s in got] == sorted((i, r, s) for i, r, _, s in want)
    assert sorted((i, d) for i, _, d, _ in got if d is not None) == sorted((i, d) for i, _, d, _ in want if d is not None)


def test_edges_and_nothing(spark, edges, nothing):
    q = edges.sparkSession.createDataFrame([(1, "word1 story"), (2, "café ß")], "item_id long, text string")
    got = sorted(tuple(r) for r in ls.search(edges, q).collect())
    rows = [(d, t) for d, t, *_ in EDGES]
    assert [(i, r, s) for i, r, _, s in got] == [(i, r, s) for i, r, _, s in brute(rows, [(1, "word1 story"), (2, "café ß")])]
    assert ls.search(nothing, q).count() == 0


def test_query_equals_sql_on_sf001(spark):
    sf = "/root/testdata/sf0.01"
    got = rows_of_spark(REGISTRY["op12_lexical_search"](spark, sf))
    assert differences(got, rows_of_duck(duck(sf), ORACLE["op12_lexical_search"])) == []


def test_updates_meet_the_remaining_terms_before_a_shuffle(spark, tiny_rows):
    """Survivors x postings of their documents are many rows: never dealt by item and term."""
    docs = spark.createDataFrame(tiny_rows, "doc_id long, text string")
    queries = spark.createDataFrame([(i, t[:300]) for i, (_, t) in enumerate(tiny_rows[:20]) if t], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ls.search(docs, queries)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"hashpartitioning\(item_id#\d+L, row#\d+L", plan)
    assert not re.search(r"hashpartitioning\(item_id#\d+L, (term|no)#", plan)
