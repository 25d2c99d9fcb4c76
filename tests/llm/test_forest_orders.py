"""The signature orders hold only rows that can be in a pair; the component search has tasks of its size."""

from __future__ import annotations

import numpy as np

from tallyloom.llm import minhash_forest
from tallyloom.sources.staging import stage


def classes_of(spark):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50_000, 60))) for i in range(300)]
    docs += [(300 + i, docs[i][1] + f" end{i}") for i in range(20)]
    sketch = minhash_forest.sketches(spark.createDataFrame(docs, "doc_id long, text string"))
    return stage(sketch.selectExpr("doc_id as node", "doc_id as root", "signature", "short"), "test-classes")


def test_orders_leave_out_rows_without_partner(spark, monkeypatch):
    classes = classes_of(spark)
    rows = minhash_forest._shared_rows(classes, 1).collect()
    assert {r["node"] for r in rows} == {*range(20), *range(300, 320)}  # before: every row of all 16 orders
    every = minhash_forest._ordered_keys(classes, 1, minhash_forest.DEPTH, "node", "root", "short").collect()
    prefix = {}
    for r in every:
        prefix.setdefault((r["tree"], bytes(r["key"][:12])), set()).add(r["root"])
    want = {(r["tree"], r["node"]) for r in every if len(prefix[r["tree"], bytes(r["key"][:12])]) > 1}
    assert {(r["tree"], r["node"]) for r in rows} == want and len(rows) == len(want)
    pairs = {(r["a"], r["b"]) for r in minhash_forest.candidates(classes, 10, 1).collect()}
    assert pairs == {(i, 300 + i) for i in range(20)}
    # with the others merged into one component nothing is left to compare
    assert minhash_forest._shared_rows(classes.selectExpr("node", "node % 300 as root", "signature", "short"), 1).isEmpty()
    monkeypatch.setattr(minhash_forest, "FEW_IDS", -1)
    assert {(r["tree"], r["node"], r["root"], r["key"], r["short"]) for r in minhash_forest._shared_rows(classes, 1).collect()} == {
        (r["tree"], r["node"], r["root"], r["key"], r["short"]) for r in rows
    }


def test_few_links_are_written_by_few_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        roots = minhash_forest.components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
        files = len(roots.inputFiles())
        assert files <= minhash_forest.FEW_TASKS and {tuple(r) for r in roots.collect()} == {(i, 0) for i in range(41)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
