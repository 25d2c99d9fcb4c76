"""The stages of the pipeline, each against brute force on its own input."""

from __future__ import annotations

import corpus_pipeline
from tallyloom.llm.catalog import REGISTRY
from tests.conftest import TINY
from tests.llm import plain


def test_stages(spark, tiny_docs, tmp_path):
    docs, seen = tiny_docs, {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, TINY).write.parquet(str(tmp_path / name))
        seen[name] = docs = spark.read.parquet(str(tmp_path / name))
        if name != "sharding":
            assert docs.columns == tiny_docs.columns
    ids = {n: sorted(r["doc_id"] for r in x.select("doc_id").collect()) for n, x in seen.items()}
    rows = {n: [(r["doc_id"], r["text"]) for r in x.select("doc_id", "text").collect()] for n, x in seen.items() if n != "sharding"}
    kept = REGISTRY["op3_quality_rules"](spark, TINY).where("kept")
    assert ids["quality_rules"] == sorted(r["doc_id"] for r in kept.collect())
    roots, _ = plain.components(rows["quality_rules"])
    assert ids["near_dedup"] == sorted({*roots.values()})
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    hit = plain.contamination(rows["near_dedup"], items)
    assert ids["decontamination"] == sorted(i for i in ids["near_dedup"] if not hit[i][-1])
    source = {r["doc_id"]: r["source"] for r in tiny_docs.collect()}
    size, taken, largest = {}, {}, {}
    for into, stage in ((size, "decontamination"), (taken, "mixing")):
        for i, text in rows[stage]:
            n = len(plain.words(text))
            into[source[i]] = into.get(source[i], 0) + n
            largest[source[i]] = max(largest.get(source[i], 0), n)
    for s, target in plain.mix_targets(size).items():
        assert abs(taken.get(s, 0) - target) <= largest[s]
    assert ids["sharding"] == ids["mixing"]
    last = spark.read.parquet(str(tmp_path / "sharding"))
    assert sorted(map(tuple, corpus_pipeline.run(spark, TINY).select("doc_id", "shard").collect())) == sorted(
        map(tuple, last.select("doc_id", "shard").collect())
    )


def test_registered():
    import __spark_entry__ as driver

    names = set(driver.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
