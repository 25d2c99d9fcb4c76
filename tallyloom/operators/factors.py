"""Multiplicative three-way model: brand baseline x country factor x store factor.

Fitted by alternating proportional updates (the Poisson maximum-likelihood fit of a
log-linear model): holding two factors fixed, a level's factor is its observed total over
its total expected from the others. The facts are reduced once to one row per
(brand, country, store) cell with its sum and count; every round is three grouped sums
over that staged table, so the facts are read once whatever the number of rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.staging import stage

ROUNDS = 5
# Factor tables up to this many levels are broadcast to the cells; larger ones are joined
# by a shuffle (a store factor table grows with the stores, a brand table rarely does).
BROADCAST_LEVELS = 200_000


def _with_factor(cells: DataFrame, factors: DataFrame, key: str, name: str) -> DataFrame:
    """Cells with the factor of their level; a null key is a level of its own."""
    right = factors.select(F.col(key).alias("__k"), F.col("f").alias(name))
    if factors.count() <= BROADCAST_LEVELS:
        right = F.broadcast(right)
    return cells.join(right, cells[key].eqNullSafe(right["__k"])).drop("__k")


def _update(cells: DataFrame, key: str, others: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """A level's factor: its observed total over the total the other factors expect there."""
    joined = cells
    for factors, other in others:
        joined = _with_factor(joined, factors, other, f"__{other}")
    expected = F.col("n")
    for _, other in others:
        expected = expected * F.col(f"__{other}")
    sums = joined.groupBy(key).agg(F.sum("y").alias("__y"), F.sum(expected).alias("__e"))
    fitted = sums.select(key, F.when(F.col("__e") > 0, F.col("__y") / F.col("__e")).otherwise(F.lit(0.0)).alias("f"))
    return stage(fitted, name)


def _mean(factors: DataFrame) -> float:
    """The mean factor over levels (one number); 1 if there are none or all are zero."""
    mean = factors.agg(F.avg("f")).first()[0]
    return float(mean) if mean else 1.0


def fit_factors(
    df: DataFrame,
    brand: str = "brand_id",
    country: str = "country",
    store: str = "store_id",
    value: str = "sales_amount",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Brand baseline, country and store factors after ``rounds`` rounds.

    A round sets, in this order, brand baselines from the country and store factors, country
    factors from brands and stores, store factors from brands and countries (each: the
    level's total of ``value`` over the sum of count x the other two factors, 0 where that
    sum is 0), then scales country and store factors to a mean of 1 over their levels and
    the baselines by the product of the two means, which leaves every product unchanged.
    Country and store factors start at 1.

    Rows with a null ``value`` count in no sum; null keys are levels of their own. Returns
    one row per (brand, country, store) cell: the three keys, ``rows`` (non-null values),
    ``total`` (their sum), ``brand_base``, ``country_factor``, ``store_factor`` and
    ``fitted_total`` (rows x the three factors). An empty input gives no rows. Repeated
    rows count as often as they occur.
    """
    cells = stage(
        df.filter(F.col(value).isNotNull())
        .groupBy(brand, country, store)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("double")).alias("y")),
        "factor-cells",
    )
    countries = stage(cells.select(country).distinct().withColumn("f", F.lit(1.0)), "country-factors")
    stores = stage(cells.select(store).distinct().withColumn("f", F.lit(1.0)), "store-factors")
    brands = None
    for _ in range(rounds):
        brands = _update(cells, brand, [(countries, country), (stores, store)], "brand-factors")
        countries = _update(cells, country, [(brands, brand), (stores, store)], "country-factors")
        stores = _update(cells, store, [(brands, brand), (countries, country)], "store-factors")
        mc, ms = _mean(countries), _mean(stores)
        # a projection of staged tables: the lineage stays one step long
        countries = countries.withColumn("f", F.col("f") / F.lit(mc))
        stores = stores.withColumn("f", F.col("f") / F.lit(ms))
        brands = brands.withColumn("f", F.col("f") * F.lit(mc * ms))
    if brands is None:
        brands = stage(cells.select(brand).distinct().withColumn("f", F.lit(0.0)), "brand-factors")
    out = _with_factor(cells, brands, brand, "brand_base")
    out = _with_factor(out, countries, country, "country_factor")
    out = _with_factor(out, stores, store, "store_factor")
    return out.select(
        brand,
        country,
        store,
        F.col("n").alias("rows"),
        F.col("y").alias("total"),
        "brand_base",
        "country_factor",
        "store_factor",
        (F.col("n") * F.col("brand_base") * F.col("country_factor") * F.col("store_factor")).alias("fitted_total"),
    )
