"""Planning totals: every level against plain sums, null keys and dates, empty input (no rows), one shuffle."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from tallyloom.operators.planning import planning_aggregates

SCHEMA = "date date, brand_id string, country string, sales_amount double, num_transactions long, promotion_flag int"


def rows():
    d = dt.date
    return [
        (d(2024, 1, 1), "b1", "c1", 10.0, 2, 1),  # a Monday
        (d(2024, 1, 7), "b1", "c1", 5.0, 1, 0),  # the Sunday of that week
        (d(2024, 1, 8), "b1", "c2", 7.0, 3, 1),
        (d(2024, 1, 8), "b1", "c2", 7.0, 3, 1),  # a repeated row counts twice
        (d(2024, 2, 1), None, "c1", 1.0, 1, 0),  # a null brand is a brand of its own
        (None, "b2", "c1", 100.0, 1, 1),  # no date: only in the grand total and null periods
        (d(2024, 2, 2), "b2", None, None, None, None),  # null measures
    ]


def test_levels_equal_plain_sums(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    found = planning_aggregates(df).collect()
    by = {(r.grain, r.period_start, r.brand_id, r.country, r.level): r for r in found}
    assert len(by) == len(found)
    total = [r for r in found if r.grain == "all"]
    assert len(total) == 1 and total[0].level == 15
    assert total[0].row_count == 7 and total[0].amount_total == 130.0 and total[0].count_total == 11
    # per week and brand: the two January weeks, February's and the null date
    weeks = {(r.period_start, r.brand_id): r.amount_total for r in found if r.grain == "week" and r.level == 5}
    assert weeks[(dt.date(2024, 1, 1), "b1")] == 15.0
    assert weeks[(dt.date(2024, 1, 8), "b1")] == 14.0
    assert weeks[(dt.date(2024, 1, 29), None)] == 1.0
    assert weeks[(None, "b2")] == 100.0
    assert weeks[(dt.date(2024, 1, 29), "b2")] is None
    # every coarser level sums its finer rows
    for grain in ("week", "month"):
        fine, coarse = defaultdict(float), {}
        for r in found:
            if r.grain == grain and r.level in (4, 8):
                fine[r.period_start] += r.row_count
            if r.grain == grain and r.level in (7, 11):
                coarse[r.period_start] = r.row_count
        assert dict(fine) == coarse


def test_empty_input_gives_no_rows(spark):
    assert planning_aggregates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_shuffle_of_partial_sums(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    plan = planning_aggregates(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    # the repartition of the input and the one exchange of the aggregation
    assert plan.count("Exchange") == 2


def test_factors_fit_nested_stores_and_keep_null_levels(spark):
    from tallyloom.operators.factors import fit_factors

    facts = [
        ("b1", "c1", 1, 10.0), ("b1", "c1", 1, 10.0), ("b1", "c2", 2, 30.0), ("b2", "c1", 3, 4.0),
        ("b2", "c2", 4, 0.0), (None, "c2", 5, 8.0), ("b2", None, 6, 2.0), ("b2", "c1", 7, None),
    ]
    df = spark.createDataFrame(facts, "brand_id string, country string, store_id long, sales_amount double")
    found = {r.store_id: r for r in fit_factors(df, rounds=3).collect()}
    # store 7 has no value: no cell; every other store is a cell of its own
    assert sorted(found) == [1, 2, 3, 4, 5, 6]
    assert found[1].rows == 2 and found[1].total == 20.0
    for r in found.values():
        # each store is in one cell, so its factor fits the cell's total exactly
        assert abs(r.fitted_total - r.total) < 1e-9 * max(1.0, r.total)
    stores = [r.store_factor for r in found.values()]
    assert abs(sum(stores) / len(stores) - 1) < 1e-12
    countries = {r.country: r.country_factor for r in found.values()}
    assert None in countries and abs(sum(countries.values()) / len(countries) - 1) < 1e-12
    assert found[4].store_factor == 0.0


def test_factors_of_nothing(spark):
    from tallyloom.operators.factors import fit_factors

    df = spark.createDataFrame([], "brand_id string, country string, store_id long, sales_amount double")
    assert fit_factors(df, rounds=2).collect() == []


def test_cold_start_phases_on_boundary_days(spark):
    from tallyloom.operators.coldstart import cold_start_forecasts

    d = dt.date
    sales = [
        (1, d(2024, 1, 31), 10.0), (1, d(2024, 4, 30), 20.0), (1, d(2024, 5, 1), 30.0),
        (1, d(2024, 7, 30), 40.0), (1, d(2024, 7, 31), 50.0),
        (2, d(2023, 1, 1), 100.0), (2, d(2024, 1, 1), 200.0), (3, None, 5.0),
    ]
    df = spark.createDataFrame(sales, "store_id long, date date, sales_amount double")
    clusters = spark.createDataFrame([(1, "a"), (2, "a")], "store_id long, cluster string")
    found = {(r.store_id, r.date): r for r in cold_start_forecasts(df, clusters).collect()}
    phases = [(found[(1, day)].months_open, found[(1, day)].phase) for day in
              (d(2024, 1, 31), d(2024, 4, 30), d(2024, 5, 1), d(2024, 7, 30), d(2024, 7, 31))]
    assert phases == [(0, "cluster"), (2, "cluster"), (3, "blend"), (5, "blend"), (6, "local")]
    # the cluster's mature days: store 2 after 12 months, and store 1 on 31 July
    first = found[(1, d(2024, 1, 31))]
    assert first.cluster_mean == 125.0 and first.local_mean is None and first.prediction == 125.0
    blend = found[(1, d(2024, 5, 1))]  # earlier months: January 10, April 20
    assert blend.local_mean == 15.0 and abs(blend.prediction - (0.7 * 125.0 + 0.3 * 15.0)) < 1e-9
    late = found[(1, d(2024, 7, 31))]  # January, April, May
    assert late.cluster_weight == 0.0 and late.prediction == 20.0
    none = found[(3, None)]
    assert none.phase is None and none.prediction is None and none.cluster is None
