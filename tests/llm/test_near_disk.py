"""Near dedup keeps no superseded table with signatures or shingle sets on disk."""

from __future__ import annotations

import os

from tallyloom.llm import minhash_forest
from tallyloom.sources.staging import checkpoint_root


def staged(spark):
    folder = f"{checkpoint_root(spark)}/staged".removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_wide_tables_are_deleted(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base[:59] + ["end"]), "some other words that are not alike", None]
    before = staged(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash_forest.near_duplicates(docs).collect()}
    assert rows == {0: (0, True), 1: (0, False), 2: (2, True), 3: (3, True)}
    left = {name.rsplit("-", 1)[0] for name in staged(spark) - before}
    assert "classes" in left and not left & {"sketches", "sets"}
