"""Windows, quantiles, PSI, CUSUM and positions against plain pandas and numpy."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators.cusum import cusum_series, cusum_series_in_blocks
from tallyloom.operators.forecast import history_windows
from tallyloom.operators.psi import feature_psi
from tallyloom.operators.quantiles import exact_quantiles
from tallyloom.operators.ranking import nth_key, positions
from tallyloom.operators.windows import window_features
from tallyloom.streaming.cusum import continue_cusum


def recurrence(values, target=0.0, slack=3.0):
    pos = neg = 0.0
    out = []
    for v in values:
        pos = max(0.0, pos + v - target - slack)
        neg = min(0.0, neg + v - target + slack)
        out.append((pos, neg))
    return out


def test_windows_equal_pandas(spark):
    rng = np.random.default_rng(7)
    pdf = pd.concat(
        [
            pd.DataFrame(
                {
                    "store_id": f"s{k}",
                    "date": pd.to_datetime("2022-01-01") + pd.to_timedelta(np.sort(rng.choice(900, n, replace=False)), "D"),
                    "sales_amount": np.round(rng.gamma(2, 500, n), 2),
                }
            )
            for k, n in enumerate([1, 3, 40, 500])
        ]
    )
    pdf["date"] = pdf["date"].dt.date
    pdf.loc[pdf.sample(30, random_state=1).index, "sales_amount"] = np.nan
    pdf = pdf.reset_index(drop=True)
    df = spark.createDataFrame(pdf).withColumn("sales_amount", F.nanvl("sales_amount", F.lit(None).cast("double")))
    ours = window_features(df).toPandas().sort_values(["store_id", "date"], ignore_index=True)
    expected = pdf.sort_values(["store_id", "date"], ignore_index=True)
    by_store = expected.groupby("store_id")["sales_amount"]
    for n in (7, 14, 30, 365):
        np.testing.assert_allclose(ours[f"sales_amount_lag_{n}d"], by_store.shift(n), rtol=1e-9)
    for n in (7, 14, 30):
        for stat in ("mean", "std", "max", "min"):
            theirs = by_store.transform(lambda x: getattr(x.rolling(n, min_periods=1), stat)())
            np.testing.assert_allclose(ours[f"sales_amount_rolling_{stat}_{n}d"], theirs, rtol=1e-6, atol=1e-6)


def skewed_columns(rows: int, seed: int = 3) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    third = rng.random(rows) < 1 / 3
    return pd.DataFrame(
        {
            "smooth": rng.normal(100, 15, rows),
            "third_equal": np.where(third, 42.0, rng.gamma(1, 60, rows)),
            "few_values": rng.integers(0, 4, rows).astype(float),
            "heavy_tail": rng.pareto(0.7, rows),
            "constant": 5.0,
        }
    )


@pytest.mark.parametrize("rows", [1, 2, 11, 12, 997, 55_000])
def test_quantiles_are_exact(spark, rows):
    pdf = skewed_columns(rows)
    probabilities = [0.0, 0.1, 0.11, 0.1101, 0.5, 0.9, 0.999, 1.0]
    found = exact_quantiles(spark.createDataFrame(pdf), list(pdf.columns), probabilities).toPandas().set_index("feature")
    for c in pdf.columns:
        np.testing.assert_allclose(
            found.loc[c, [f"q{i}" for i in range(len(probabilities))]].astype(float),
            np.quantile(pdf[c], probabilities),
            rtol=1e-12,
        )


def test_quantiles_skip_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (4.0, None)], "x double, y double")
    rows = {r.feature: r for r in exact_quantiles(df, ["x", "y"], [0.5]).collect()}
    assert (rows["x"].q0, rows["x"].n, rows["x"].missing) == (2.5, 2, 2)
    assert (rows["y"].q0, rows["y"].n, rows["y"].missing) == (None, 0, 4)


def psi_by_hand(expected: np.ndarray, actual: np.ndarray, bins: int = 10) -> float:
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0

    def shares(values):
        inside = values[(values >= edges[0]) & (values <= edges[-1])]
        bin_of = np.clip(np.searchsorted(edges, inside, side="left"), 1, None)
        counts = np.bincount(bin_of, minlength=len(edges))[1:]
        return (counts / counts.sum() if counts.sum() else np.full(len(counts), 0.001)) + 1e-10

    e, a = shares(expected), shares(actual)
    return float(np.sum((a - e) * np.log(a / e)))


@pytest.mark.parametrize("rows", [15, 800, 40_000])
def test_psi_equals_hand_computation(spark, rows):
    base, now = skewed_columns(rows, 1), skewed_columns(rows // 2, 2) * 1.2
    pdf = pd.concat([base.assign(base=True), now.assign(base=False)])
    found = feature_psi(spark.createDataFrame(pdf), list(base.columns), F.col("base")).collect()
    assert {r.feature for r in found} == set(base.columns)
    for r in found:
        assert r.psi == pytest.approx(psi_by_hand(base[r.feature].to_numpy(), now[r.feature].to_numpy()), abs=1e-9)


def test_cusum_in_blocks_equals_recurrence_with_one_hot_key(spark):
    """One key holds a third of the rows; its series is spread over many blocks."""
    rng = np.random.default_rng(11)
    keys = np.where(rng.random(6000) < 1 / 3, 0, rng.integers(1, 60, 6000))
    pdf = pd.DataFrame({"k": keys, "i": np.arange(6000), "e": np.round(rng.normal(0, 4, 6000), 2)})
    df = spark.createDataFrame(pdf).repartition(6)
    expected = {}
    for _, g in pdf.groupby("k"):
        expected.update(dict(zip(g["i"], recurrence(g["e"], 0.5))))
    blocks = cusum_series_in_blocks(df, ["k"], ["i"], "e", F.floor(F.col("i") / 50), target=0.5)
    whole = cusum_series(df, ["k"], ["i"], "e", target=0.5)
    for found in (blocks.collect(), whole.collect()):
        assert len(found) == 6000
        got = np.array([(r.cusum_pos, r.cusum_neg) for r in found])
        np.testing.assert_allclose(got, [expected[r.i] for r in found], atol=1e-8)


def test_cusum_in_blocks_keeps_precision_after_large_totals(spark):
    """Earlier blocks drift by -1e12 a row (totals near -1e16); later blocks add 0.2 a row.

    A difference of two running totals of that size rounds to units of 2; the entering sums
    carried block by block keep the small upper sums exact.
    """
    values = [-1e12] * 10000 + [3.2] * 200 + [-2.9] * 200
    pdf = pd.DataFrame({"k": 0, "i": np.arange(len(values)), "e": values})
    df = spark.createDataFrame(pdf).repartition(4)
    blocks = cusum_series_in_blocks(df, ["k"], ["i"], "e", F.floor(F.col("i") / 100))
    found = sorted(blocks.collect(), key=lambda r: r.i)
    got = np.array([(r.cusum_pos, r.cusum_neg) for r in found])
    expected = np.array(recurrence(values))
    np.testing.assert_allclose(got[10000:, 0], expected[10000:, 0], rtol=0, atol=1e-9)
    # the lower sum itself is near -1e16; it agrees to the precision of doubles
    np.testing.assert_allclose(got[:, 1], expected[:, 1], rtol=1e-12)


def test_cusum_restarts_with_a_segment(spark):
    rows = [("a", i, i // 3, 6.0) for i in range(6)]
    df = spark.createDataFrame(rows, "k string, i int, part int, e double")
    out = cusum_series(df, ["k"], ["i"], "e", segment="part").orderBy("i").collect()
    assert [r.cusum_pos for r in out] == pytest.approx([3.0, 6.0, 9.0, 3.0, 6.0, 9.0])


@given(st.lists(st.floats(-50, 50), min_size=1, max_size=60), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_continued_cusum_equals_recurrence(values, cut):
    cut = min(cut, len(values))
    pos = neg = 0.0
    found = []
    for part in (values[:cut], values[cut:]):
        if part:
            up, down = continue_cusum(np.array(part), 3.0, pos, neg)
            pos, neg = up[-1], down[-1]
            found += list(zip(up, down))
    np.testing.assert_allclose(found, recurrence(values), atol=1e-8)


def test_positions_with_text_keys_and_a_hot_group(spark):
    rows = [("hot", f"k{(i * 7919) % 5000:05d}") for i in range(5000)] + [("b", "x"), ("b", "a"), ("c", "m")]
    df = spark.createDataFrame(rows, "g string, k string").repartition(6)
    found = {(r.g, r.k): r.position for r in positions(df, ["g"], "k", ranges=16).collect()}
    for g in ("hot", "b", "c"):
        keys = sorted(k for x, k in rows if x == g)
        assert [found[g, k] for k in keys] == list(range(len(keys)))
    wanted = df.withColumn("at", F.when(F.col("g") == "hot", 3333).otherwise(0))
    assert {r.g: r.nth for r in nth_key(wanted, ["g"], "k", "at").collect()} == {"hot": "k03333", "b": "a", "c": "m"}


def test_history_windows_equal_a_loop(spark):
    rng = np.random.default_rng(5)
    days = np.sort(rng.choice(500, 220, replace=False))
    pdf = pd.DataFrame({"d": days, "y": np.round(rng.gamma(2, 100, 220), 2)})
    start = pd.Timestamp("2022-01-01")
    history = spark.createDataFrame(
        [("a", (start + pd.Timedelta(days=int(d))).date(), float(y)) for d, y in zip(pdf.d, pdf.y)],
        "store_id string, date date, sales_amount double",
    )
    last = int(days[-1])
    spine = spark.createDataFrame(
        [("a", (start + pd.Timedelta(days=last + h)).date()) for h in range(1, 31)], "store_id string, date date"
    )
    for row in history_windows(spine, history).collect():
        at = (pd.Timestamp(row.date) - start).days
        for n in (7, 14, 30, 365):
            hit = pdf.loc[pdf.d == at - n, "y"]
            assert row[f"sales_amount_lag_{n}d"] == (hit.iloc[0] if len(hit) else 0.0)
        for n in (7, 14, 30):
            seen = pdf.loc[(pdf.d >= at - n) & (pdf.d < at), "y"]
            for stat in ("mean", "std", "max", "min"):
                expected = getattr(seen, stat)() if len(seen) else 0.0
                got = row[f"sales_amount_rolling_{stat}_{n}d"]
                assert (got is None and np.isnan(expected)) or got == pytest.approx(expected)


def test_quantiles_shuffle_few_values(spark, monkeypatch):
    """Long tails, ties, infinities and both zeros are exact, though few values are counted one by one."""
    from tallyloom.operators import quantiles

    rng, staged, real = np.random.default_rng(5), {}, quantiles.stage
    n = 40_000
    pdf = pd.DataFrame(
        {
            "even": rng.uniform(-3, 3, n), "tail": np.exp(rng.normal(0, 3, n)), "steep": np.exp(rng.normal(0, 8, n)), "ties": rng.integers(0, 5, n) - 2.0,
            "zero": np.where(rng.random(n) < 0.5, 0.0, -0.0), "huge": rng.choice([-1e308, 0.5, 1e308], n),
            "ends": np.where(rng.random(n) < 0.1, np.inf, rng.normal(0, 1, n)),
        }
    )

    def keep(df, name):
        staged[name] = real(df, name)
        return staged[name]

    monkeypatch.setattr(quantiles, "stage", keep)
    monkeypatch.setattr(quantiles, "FEW_ROWS", 1_000)
    shares = [i / 10 for i in range(11)]
    found = quantiles.exact_quantiles(spark.createDataFrame(pdf), list(pdf.columns), shares).toPandas().set_index("feature")
    for c in pdf.columns:
        ordered = np.sort(pdf[c].to_numpy())
        for i, p in enumerate(shares):
            at = p * (n - 1)
            low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
            want = low + (high - low) * (at - math.floor(at)) if low != high else low
            got = found.loc[c, f"q{i}"]
            assert got == want or (np.isnan(got) and np.isinf(low)), (c, p, got, want)
    counted = dict(staged["value-counts"].groupBy("feature").count().collect())
    assert counted[0] + counted[1] < n / 10


def test_stability_reads_its_rows_three_times_without_a_row_per_value(spark, monkeypatch):
    """Rows with a value per line, joined to the edges of their feature, cost most of the time on large tables."""
    from tallyloom.operators import psi, quantiles

    rng, n = np.random.default_rng(8), 6_000
    pdf = pd.DataFrame({"a": rng.gamma(1, 60, n), "year": rng.integers(1990, 2000, n).astype(float), "base": np.arange(n) < 4_000})
    pdf.loc[::7, "a"] = np.nan
    reads, real = [], quantiles.packed_values
    for module in (psi, quantiles):
        monkeypatch.setattr(module, "packed_values", lambda columns: reads.append(columns) or real(columns))
    monkeypatch.setattr(quantiles, "BLOCK", 500)
    monkeypatch.setattr(quantiles, "KEPT", 100)  # tasks return their counts several times
    monkeypatch.setattr(quantiles, "FEW_ROWS", 1_500)
    found = psi.feature_psi(spark.createDataFrame(pdf), ["a", "year"], F.col("base"), null_policy="ignore")
    got = {r.feature: r.psi for r in found.collect()}
    assert len(reads) == 3
    for c in ("a", "year"):
        known = pdf[pdf[c].notna()]
        want = psi_by_hand(known.loc[known["base"], c].to_numpy(), known.loc[~known["base"], c].to_numpy())
        assert got[c] == pytest.approx(want, abs=1e-9)


def test_quantiles_of_values_that_differ_in_their_last_bits(spark, monkeypatch):
    from tallyloom.operators import quantiles

    rng = np.random.default_rng(9)
    x = np.nextafter(1e6, 2e6) + np.spacing(1e6) * rng.integers(0, 30_000, 20_000)
    monkeypatch.setattr(quantiles, "FEW_ROWS", 100)
    found = quantiles.exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": x, "y": -x})), ["x", "y"], [0.25, 0.5]).toPandas().set_index("feature")
    ordered = np.sort(x)
    for c, s in (("x", ordered), ("y", np.sort(-x))):
        for i, p in enumerate((0.25, 0.5)):
            at = p * (len(x) - 1)
            low, high = s[math.floor(at)], s[math.ceil(at)]
            assert found.loc[c, f"q{i}"] == low + (high - low) * (at - math.floor(at))
