"""Registered queries against brute force, round trips and held-out accuracy, on whole tables."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tallyloom.llm import fm_index, lm_scoring, minhash_forest, pii, quality_model, quality_rules, tokens
from tallyloom.llm.catalog import REGISTRY
from tests.conftest import TINY
from tests.llm import plain

SMALL = "/root/testdata/sf0.01"


def rows_of(spark, name, sf_dir=TINY):
    return REGISTRY[name](spark, sf_dir).collect()


def test_base_scores_and_model(spark, tiny_rows):
    want = plain.base_scores(tiny_rows)
    rows = rows_of(spark, "op1_gated_lm")
    assert len(rows) == len(tiny_rows)
    for r in rows:
        n, known, train, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_network_chances_gradient_and_lanes():
    rng = np.random.default_rng(0)
    net = lm_scoring.Network(np.array([50, 10] + [30 - i for i in range(20)]), hidden=5, classes=6)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    h = rng.normal(size=(7, 5))
    every = np.stack([net.log_chances(h, np.full(7, t)) for t in range(22)])
    assert np.allclose(np.exp(every).sum(axis=0), 1)
    targets = rng.integers(0, 22, 7)
    _, grads, back = net.log_chances(h, targets, gradient=True)

    def loss():
        return -net.log_chances(h, targets).sum()

    for name in ("c", "cb", "w", "wb"):
        at = tuple(rng.integers(0, n) for n in net.p[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-6
        up = loss()
        net.p[name][at] = old - 1e-6
        assert math.isclose((up - loss()) / 2e-6, grads[name][at], abs_tol=1e-5)
        net.p[name][at] = old
    symbols, first = rng.integers(0, 22, 600).astype(np.int32), np.array([0, 20, 35, 36, 400, 600])
    alone = []
    for d in range(5):
        state, read, total = np.zeros((1, 5)), lm_scoring.END, 0.0
        for t in symbols[first[d] : first[d + 1]]:
            state, _ = net.step(np.array([read]), state)
            total += net.log_chances(state, np.array([t]))[0]
            read = t
        alone.append(total)
    assert np.allclose(lm_scoring.score(net, symbols, first), alone, rtol=1e-5)


def test_mix_targets_and_words(spark, tiny_docs):
    rows = {r["doc_id"]: r for r in rows_of(spark, "op2_mixing")}
    size, taken, target, largest = {}, {}, {}, {}
    for d in tiny_docs.collect():
        r, s = rows[d["doc_id"]], d["source"]
        assert r["size"] == len(plain.words(d["text"])) and r["taken"] <= 2 * r["size"]
        size[s], taken[s], target[s] = size.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"], r["target"]
        largest[s] = max(largest.get(s, 0), r["size"])
    want = plain.mix_targets(size)
    for s in size:
        assert math.isclose(target[s], float(want[s]), rel_tol=1e-12)
        assert abs(taken[s] - target[s]) <= largest[s]
    again = {r["doc_id"]: r for r in rows_of(spark, "op2_mixing")}
    assert again == rows


def test_rule_measures_and_verdicts(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in rows_of(spark, "op3_quality_rules", SMALL)}
    for i, text in texts:
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain.base_measures(text)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    judged = [(r["quality"], rows[r["doc_id"]]["kept"]) for r in labels if not rows[r["doc_id"]]["base_failed"]]
    good, bad = ([k for q, k in judged if q == v] for v in (1, 0))
    assert all(good) and sum(bad) <= 0.1 * len(bad)


def test_likelihood_ratio_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "c c"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    counts = {r["bucket"]: (r["raw"], r["target"]) for r in quality_rules.bucket_counts(docs, labels.select("doc_id")).collect()}
    # words a 2, b 1, c 2; pairs ab, ba, cc
    assert sorted(counts.values()) == sorted([(2, 2), (1, 1), (2, 0), (1, 1), (1, 1), (1, 0)])
    got = {r["doc_id"]: r["score"] for r in quality_rules.rule_digest(docs, labels).collect()}
    share = 5 / 8

    def log(raw, target):
        return math.log((target + 5) / (raw * share + 5))

    assert math.isclose(got[1], (2 * log(2, 2) + log(1, 1) + 2 * log(1, 1)) / 5, abs_tol=1e-6)
    assert math.isclose(got[2], (2 * log(2, 0) + log(1, 0)) / 3, abs_tol=1e-6) and got[3] == 0


def test_near_duplicate_components(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    roots, sizes = plain.components(docs)
    rows = rows_of(spark, "op4_minhash_forest", SMALL)
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in rows} == {i: (roots[i], sizes[i]) for i in roots}
    assert all(r["kept"] == (roots[r["doc_id"]] == r["doc_id"]) for r in rows)


def test_crowded_regions_keep_their_links(spark):
    """One large group of near copies, chained so that its ends are far apart."""
    rng = np.random.default_rng(4)
    base = [f"v{i}" for i in range(150)]
    docs = []
    for i in range(400):
        w = list(base)
        for p in rng.integers(0, 150, 3):
            w[p] = f"e{i}x{p}"
        docs.append((i, " ".join(w)))
    drift = list(base)
    for i in range(400, 440):  # each step away from the last one, out of reach of the first
        for p in rng.integers(0, 150, 2):
            drift[p] = f"d{i}x{p}"
        docs.append((i, " ".join(drift)))
    roots, _ = plain.components(docs)
    rows = minhash_forest.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == roots


def test_component_search_on_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 300)]
    links = spark.createDataFrame(path + star + [(5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in minhash_forest.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}}


def test_boilerplate_lines(spark, tiny_docs):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in tiny_docs.collect()]
    want = plain.without_lines(docs, 6)
    assert {r["doc_id"]: r["text"] for r in rows_of(spark, "op5_line_spread")} == want


def test_links_in_a_crowd_of_template_texts(spark):
    """Texts of one template, alike at about 0.7, with one link of 0.8 and no shingle that is rare."""
    rng = np.random.default_rng(7)
    n, slots = 2000, 225
    picks = [set(rng.choice(slots, 22, replace=False).tolist()) for _ in range(n)]
    planted = [(i, 1999 - 610 * i) for i in range(3)]
    for a, b in planted:
        others = [x for x in range(slots) if x not in picks[a]]
        picks[b] = set(sorted(picks[a])[::2][:10]) | set(rng.choice(others, 12, replace=False).tolist())
    docs = [(i, " ".join(f"{'alt' if w % 4 == 0 and w // 4 in p else 't'}{w}" for w in range(4 * slots))) for i, p in enumerate(picks)]
    # a word of a slot is in four shingles of its own, the first word in one
    state = np.array([[x in p for x in range(slots)] for p in picks], float)
    size = np.array([1.0] + [4.0] * (slots - 1))
    both = (state * size) @ state.T + ((1 - state) * size) @ (1 - state).T
    links = np.argwhere(np.triu(100 * both >= 80 * (2 * size.sum() - both), 1)).tolist()
    assert [2, 779] in links and len(links) < 30
    gone = {b for a, b in links if a != 2}
    docs = [(i, text) for i, text in docs if i not in gone]
    rows = minhash_forest.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(8)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: 2 if i == 779 else i for i, _ in docs}


def test_spread_of_hot_and_near_lines(spark):
    from tallyloom.llm import line_dedup

    rows = [(i, "hot line\nnear line\nown line %d" % i if i % 40 < 6 else "hot line\nbelow" if i % 40 < 11 else "hot line", f"s{i % 40}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in line_dedup.without_boilerplate(docs, min_sites=6).collect()}
    want = plain.without_lines(rows, 6)
    assert {i: r["text"] for i, r in out.items()} == want and want[7] == "below" and want[0] == "own line 0"


def test_contamination(spark, tiny_rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    want = plain.contamination(tiny_rows, items)
    rows = rows_of(spark, "op6_fm_index")
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and any(x[-1] for x in want.values())


@pytest.mark.parametrize("n", [0, 1, 2, 50, 400])
def test_index_finds_all_places(n):
    rng = np.random.default_rng(n)
    x = rng.integers(1, 4, n)
    x = np.concatenate([x, x[: n // 2]])
    full = [*x.tolist(), 0]
    assert fm_index.suffix_array(np.array(full)).tolist() == sorted(range(len(full)), key=lambda i: full[i:])
    index = fm_index.FMIndex(x)
    for m in (1, 2, 5):
        patterns = rng.integers(1, 6, (40, m))
        low, high = index.search(patterns, np.full(40, m))
        for i, p in enumerate(patterns.tolist()):
            want = [j for j in range(len(x) - m + 1) if x[j : j + m].tolist() == p]
            assert sorted(index.locate(np.arange(low[i], high[i])).tolist()) == want


def test_languages_of_held_out_texts(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()}
    rows = rows_of(spark, "op7_byte_cnn", SMALL)
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(r["held_out"] == (plain.fold(r["doc_id"], 4) == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_shards_of_near_equal_bytes(spark):
    import zlib

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = rows_of(spark, "op8_sharding", SMALL)
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    total, slots = {}, {}
    for r in rows:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    mean, largest = sum(total.values()) / 24, max(r["size"] for r in rows)
    assert len(total) == 24 and all(abs(b - mean) <= 0.04 * mean + largest for b in total.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_hot_group_is_split(spark):
    from tallyloom.llm import sharding

    docs = spark.createDataFrame([(i, "same text" if i % 3 == 0 else f"text {i:05d}") for i in range(3000)], "doc_id long, text string")
    rows = sharding.shard_rows(docs).collect()
    total = {}
    for r in rows:
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
    mean = sum(total.values()) / 24
    assert all(abs(b - mean) < 0.05 * mean for b in total.values())


def test_surrogates_keep_types_and_identity(spark):
    texts = [
        "Mail ada.l@corp.org or call +1 (212) 555-0101, card 4111 1111 1111 1111.",
        "ADA.L@corp.org again, +1 212 555 0101, token = \"0123456789abcdef0123456789abcdef01234567\"",
        "Frau Erika Muster und Herr Max Muster; 10.0.0.1 and 999.1.1.1; Mrs. Anna Bell",
        "Nothing here. 12 apples, 3.5 kg.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: (r["text"], r["n_entities"]) for r in pii.with_surrogates(docs).collect()}
    assert [out[i][1] for i in range(4)] == [3, 3, 4, 0] and out[3][0] == texts[3]
    for i in range(3):
        before, after = pii.find(texts[i]), pii.find(out[i][0])
        assert [k for *_, k in before] == [k for *_, k in after]
        for (s, e, kind), (s2, e2, _) in zip(before, after):
            assert texts[i][s:e] != out[i][0][s2:e2]
            if kind in ("phone", "card", "secret"):
                shape = [c if not c.isalnum() else "x" for c in texts[i][s:e]]
                assert shape == [c if not c.isalnum() else "x" for c in out[i][0][s2:e2]]
    mail = [next(t[s:e] for s, e, k in pii.find(t) if k == "email") for t in (out[0][0], out[1][0])]
    assert mail[0] == mail[1]
    names = [out[2][0][s:e].split()[0] for s, e, k in pii.find(out[2][0]) if k == "name"]
    assert names[0] in pii.NAMES["LATIN", "f"] and names[1] in pii.NAMES["LATIN", "m"] and names[2] in pii.NAMES["LATIN", "f"]


def test_surrogates_stay_distinct_when_draws_collide(spark, monkeypatch):
    real = pii.surrogate

    def crowded(key, kind, entity, attempt, gender="n"):
        return real(key, kind, entity, attempt, gender) if attempt > 1 else "10.0.0.7"

    monkeypatch.setattr(pii, "surrogate", crowded)
    mentions = spark.createDataFrame([("ip", f"1.1.1.{i}", "n") for i in range(50)] + [("ip", "10.0.0.7", "n")], "kind string, entity string, gender string")
    rows = pii.assignments(mentions, b"k").collect()
    assert len(rows) == 51 == len({r["surrogate"] for r in rows}) and not {r["surrogate"] for r in rows} & {r["entity"] for r in rows}


def test_surrogates_by_join_equal_those_by_lookup(spark, tiny_docs, monkeypatch):
    docs = tiny_docs.select("doc_id", "text")
    want = {r["doc_id"]: r["text"] for r in pii.with_surrogates(docs).collect()}
    monkeypatch.setattr(pii, "FEW_REDRAWN", -1)
    assert {r["doc_id"]: r["text"] for r in pii.with_surrogates(docs).collect()} == want


def test_quality_of_held_out_texts(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    held = [r for r in rows_of(spark, "op10_fourier_features", SMALL) if r["held_out"] and r["doc_id"] in label]
    good = [r["score"] for r in held if label[r["doc_id"]] == 1]
    bad = [r["score"] for r in held if label[r["doc_id"]] == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins >= 0.97 * len(good) * len(bad)
    assert sum(r["predicted"] == label[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_pooled_values_are_the_closest_rising_ones():
    got = quality_model.isotonic(np.array([0.1, 0.5, 0.3, 0.9, 0.2]), np.array([1.0, 1, 3, 1, 1]))
    assert np.allclose(got, [0.1, 0.35, 0.35, 0.55, 0.55])


def test_kernels_equal_plain_words():
    import pyarrow as pa

    texts = ["", "a  b\tc", "é\x00x y\n", "one", "x" * 50, None, "A b C d e"]
    seen = []
    for at, end, buf, offsets in tokens.blocks(pa.array(texts), limit=8):
        buf = tokens.LOWER[buf]
        starts, ends, first = tokens.spans(buf, offsets, tokens.NOT_SPACE)
        hashes = tokens.word_hashes(buf, starts, ends)
        for d in range(end - at):
            seen.append(hashes[first[d] : first[d + 1]].tolist())
    assert seen == [tokens.hash_of(plain.words(t, True)).tolist() if plain.words(t) else [] for t in texts]


def test_frequent_words_are_bounded(spark):
    rows = [(i, 1000 - i) for i in range(300)] + [(1000 + i, 1) for i in range(700)]
    table = spark.createDataFrame(rows, "word long, n long")
    every = lm_scoring.Counts.of(table, ends=5, head=2000, symbols=12)
    assert len(every.hashes) == 1000 and (every.n, every.distinct) == (sum(n for _, n in rows) + 5, 1001)
    assert sorted(every.hashes[every.symbols > 0]) == list(range(10))
    assert every.other_distinct == 990 and every.other_n == every.n - 5 - sum(1000 - i for i in range(10))
    some = lm_scoring.Counts.of(table, ends=5, head=100, symbols=12)
    assert 50 <= len(some.hashes) <= 150 and set(range(40)) <= set(some.hashes.tolist())
    flat = lm_scoring.Counts.of(table.where("n = 1"), ends=5, head=100, symbols=12)
    assert 60 <= len(flat.hashes) <= 140 and (flat.symbols > 0).sum() == 10
