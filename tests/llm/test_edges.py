"""Every operator on nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import (
    decontamination,
    language_id,
    line_dedup,
    lm_scoring,
    minhash_forest,
    mixing,
    pii,
    quality_model,
    quality_rules,
    sharding,
)
from tests.llm import plain
from tests.llm.conftest import EDGES, PROSE


def by_id(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r["doc_id"], []).append(r)
    return rows


def same_columns(df, docs):
    assert df.columns == docs.columns
    row = df.where("doc_id = 7").first()
    assert row is None or row["_doc"] == 0 and row["label"] == len(docs.columns) - 5


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, PROSE), (2, None), (None, PROSE), (3, "a b c"), (3, "a b c"), (4, ""), (5, "%%%")], "item_id long, text string"
    )


def test_scores(edges, nothing):
    rows = by_id(lm_scoring.scores(edges))
    assert sum(map(len, rows.values())) == len(EDGES)
    for i in (2, 3, 4):
        assert rows[i][0]["n_tokens"] == 1
    assert tuple(rows[1][0])[:6] == tuple(rows[1][1])[:6] and math.isclose(rows[1][0]["score"], rows[1][1]["score"], rel_tol=1e-5)
    assert all(r["score"] < 0 for x in rows.values() for r in x)
    assert not rows[None][0]["held_out"]
    assert lm_scoring.scores(nothing).count() == 0


def test_scores_without_training_rows(edges):
    rows = lm_scoring.scores(edges.where("doc_id is null")).collect()
    assert len(rows) == 2 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in rows)


def test_mixing(edges, nothing):
    rows = by_id(mixing.mix_counts(edges))
    assert rows[2][0]["size"] == rows[3][0]["size"] == rows[4][0]["size"] == 0
    assert rows[1][0] == rows[1][1]
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for x in rows.values() for r in x)
    mixed = mixing.mix(edges)
    same_columns(mixed, edges)
    taken = sum(r["taken"] for x in rows.values() for r in x)
    assert sum(len(plain.words(r["text"])) for r in mixed.select("text").collect()) == taken
    assert mixing.mix_counts(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_mixing_of_empty_texts(edges):
    rows = mixing.mix_counts(edges.where("doc_id in (2, 3, 4)")).collect()
    assert len(rows) == 3 and all(r["taken"] == 0 and r["target"] == 0 for r in rows)


def test_quality_rules(edges, nothing, labels):
    rows = by_id(quality_rules.rule_digest(edges, labels))
    for i, text, *_ in EDGES:
        r = rows[i][0]
        if i is not None:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain.base_measures(text)
    assert not rows[2][0]["kept"] and rows[1][0] == rows[1][1]
    passed = quality_rules.passing(edges, labels)
    same_columns(passed, edges)
    assert passed.count() == sum(r["kept"] for x in rows.values() for r in x)
    assert quality_rules.rule_digest(nothing, labels).count() == 0
    bare = quality_rules.rule_digest(edges, labels.where("false"))
    assert all(r["kept"] != r["base_failed"] for r in bare.collect())


def test_near_duplicates(edges, nothing):
    rows = by_id(minhash_forest.near_duplicates(edges))
    assert sum(map(len, rows.values())) == len(EDGES)
    assert [rows[i][0]["component_id"] for i in (1, -11, 5, 6, 7, 8, 2, 3, 4)] == [-11, -11, 5, 5, 7, 7, 2, 3, 4]
    assert rows[2][0]["n_shingles"] == rows[4][0]["n_shingles"] == 0 and rows[7][0]["n_shingles"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in rows[None])
    assert [rows[i][0]["kept"] for i in (1, -11, 5, 6)] == [False, True, True, False]
    assert minhash_forest.near_duplicates(nothing).count() == 0


def test_one_of_each(edges, nothing):
    left = minhash_forest.one_of_each(edges.where("doc_id != -11"))
    same_columns(left, edges)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4, 5, 7, 9, 10]
    assert minhash_forest.one_of_each(edges.where("doc_id is null")).count() == 2
    assert minhash_forest.one_of_each(nothing).count() == 0


def test_boilerplate(edges, nothing):
    cut = line_dedup.without_boilerplate(edges.select("doc_id", "text", "source", "_row", "n_lines"), min_sites=2)
    rows = by_id(cut)
    want = plain.without_lines([(i, t, s) for i, t, _, s in EDGES], 2)
    assert sum(map(len, rows.values())) == len(EDGES)
    assert all(rows[i][0]["text"] == want[i] for i in want if i is not None)
    assert cut.columns == ["doc_id", "text", "source", "_row", "n_lines", "n_removed"] and rows[1][0] == rows[1][1]
    assert rows[10][0]["text"] == "Café ß œuvre\nCafé ß œuvre\n\nfin" and rows[1][0]["n_removed"] == 1
    assert line_dedup.without_boilerplate(nothing).count() == 0


def test_decontamination(edges, nothing, benchmark):
    rows = by_id(decontamination.contamination(edges, benchmark))
    items = [(i, t) for i, t in ((1, PROSE), (3, "a b c"))]
    want = plain.contamination([(r[0], r[1]) for r in EDGES], items)
    assert sum(map(len, rows.values())) == len(EDGES)
    for i, expected in want.items():
        if i is not None:
            assert tuple(rows[i][0])[1:] == expected
    left = decontamination.uncontaminated(edges, benchmark)
    same_columns(left, edges)
    assert {r["doc_id"] for r in left.collect()} == {None, *(i for i, x in want.items() if i is not None and not x[-1])}
    assert decontamination.contamination(nothing, benchmark).count() == 0
    assert decontamination.contamination(edges, benchmark.where("false")).where("contaminated").count() == 0


def test_decontamination_in_blocks_and_cuts(edges, benchmark):
    spans = decontamination.contaminated_spans(edges, benchmark)
    blocks = decontamination.contaminated_spans(edges, benchmark, block_bytes=300)
    key = [F.col("doc_id"), F.hash("text"), "starts", "ends", "items"]
    assert sorted(map(str, spans.select(*key).collect())) == sorted(map(str, blocks.select(*key).collect()))
    texts = by_id(spans.select("doc_id", decontamination.cut("text", "starts", "ends").alias("text")))
    assert texts[-11][0]["text"] == " end" and texts[7][0]["text"] == "" and texts[2][0]["text"] is None


def test_languages(edges, nothing):
    rows = by_id(language_id.languages(edges))
    assert sum(map(len, rows.values())) == len(EDGES)
    assert all(rows[i][0]["lang_pred"] == "und" and rows[i][0]["score"] == 0 for i in (2, 3, 4, 9))
    assert rows[1][0] == rows[1][1] and rows[10][0]["lang_pred"] in ("en", "de", "fr")
    assert language_id.languages(nothing).count() == 0
    assert {r["lang_pred"] for r in language_id.languages(edges.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_shards(edges, nothing):
    rows = [r for x in by_id(sharding.shard_rows(edges)).values() for r in x]
    assert len(rows) == len(EDGES) and all(0 <= r["shard"] < 24 for r in rows)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_rows(nothing).count() == 0


def test_surrogates(spark, edges, nothing):
    docs = edges.withColumn("text", F.when(F.col("doc_id") == 7, "Mrs. Ada Smith: ada@x.org").otherwise(F.col("text")))
    out = pii.with_surrogates(docs)
    assert out.columns == [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
    rows = by_id(out)
    assert sum(map(len, rows.values())) == len(EDGES) and rows[2][0]["text"] is None
    assert rows[7][0]["n_entities"] == 2 and rows[1][0]["text"] == PROSE
    assert pii.with_surrogates(nothing).count() == 0


def test_quality_scores(edges, nothing, labels):
    rows = by_id(quality_model.quality_scores(edges, labels))
    assert sum(map(len, rows.values())) == len(EDGES)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for x in rows.values() for r in x)
    assert rows[1][0] == rows[1][1] and rows[2][0]["score"] == rows[3][0]["score"]
    assert quality_model.quality_scores(nothing, labels).count() == 0
    assert {r["score"] for r in quality_model.quality_scores(edges, labels.where("false")).collect()} == {0.5}
