"""Cold start: forecasts of young stores from their cluster, blended into their own history.

Months since opening set the phase: under ``CLUSTER_MONTHS`` a store takes its cluster's
mean day; up to ``LOCAL_MONTHS`` a blend of ``BLEND_CLUSTER`` cluster and the rest local;
from then on its own mean. The store's own mean comes from monthly sums carried over the
months before the day's month, so windows run over (store, month) rows, never over days:
a store with a third of all days is one row a month there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Phase bounds in months and the blend weight of the cluster.
CLUSTER_MONTHS = 3
LOCAL_MONTHS = 6
BLEND_CLUSTER = 0.7


def months_open(day: Column, opened: Column) -> Column:
    """Whole months from ``opened`` to ``day``: calendar months less one if the day of the
    month is not reached yet (31 Jan to 30 Apr is 2, to 1 May is 3)."""
    months = (F.year(day) * 12 + F.month(day)) - (F.year(opened) * 12 + F.month(opened))
    return months - F.when(F.dayofmonth(day) < F.dayofmonth(opened), 1).otherwise(0)


def cold_start_forecasts(
    sales: DataFrame,
    clusters: DataFrame,
    store: str = "store_id",
    date: str = "date",
    value: str = "sales_amount",
    cluster: str = "cluster",
) -> DataFrame:
    """One row per row of ``sales`` with its phase, weights and prediction.

    ``clusters`` maps ``store`` to ``cluster`` (one row per store; a store missing there, or
    a null cluster, is a cluster of its own, null). A store opens on its first dated row.
    ``cluster_mean`` is the mean ``value`` over rows of mature stores' days (months_open >=
    ``LOCAL_MONTHS``) in the cluster; ``local_mean`` the store's mean over its calendar months
    before the day's month (null in its first month). The prediction is cluster_weight x
    cluster_mean + (1 - cluster_weight) x local_mean with weights 1, ``BLEND_CLUSTER`` and 0 by
    phase ('cluster', 'blend', 'local'); where a mean is null the other one stands alone, and
    both null give null. Rows with a null date have phase null and keep null predictions;
    null values count in no mean. Repeated rows count as often as they occur.

    Returns store, date, value, cluster, months_open, phase, cluster_mean, local_mean,
    cluster_weight, prediction.
    """
    opened = sales.groupBy(store).agg(F.min(date).alias("__opened"))
    mapped = clusters.select(F.col(store).alias("__s"), F.col(cluster).alias("__cluster"))
    rows = (
        sales.select(store, date, value)
        .join(opened, store, "left")
        .join(mapped, F.col(store).eqNullSafe(F.col("__s")), "left")
        .drop("__s")
        .withColumn("__months", months_open(F.col(date), F.col("__opened")))
        .withColumn("__month", F.trunc(date, "month"))
    )
    mature = (
        rows.filter(F.col("__months") >= LOCAL_MONTHS)
        .groupBy(F.col("__cluster").alias("__mc"))
        .agg(F.avg(value).alias("cluster_mean"))
    )
    monthly = rows.filter(F.col("__month").isNotNull()).groupBy(store, "__month").agg(
        F.sum(value).alias("__sum"), F.count(value).alias("__n")
    )
    before = W.partitionBy(store).orderBy("__month").rowsBetween(W.unboundedPreceding, -1)
    local = monthly.select(
        F.col(store).alias("__ls"), F.col("__month").alias("__lm"),
        (F.sum("__sum").over(before) / F.sum("__n").over(before)).alias("local_mean"),
    )
    joined = (
        rows.join(mature, F.col("__cluster").eqNullSafe(F.col("__mc")), "left")
        .join(local, F.col(store).eqNullSafe(F.col("__ls")) & (F.col("__month") == F.col("__lm")), "left")
    )
    months = F.col("__months")
    phase = (
        F.when(months.isNull(), F.lit(None))
        .when(months < CLUSTER_MONTHS, F.lit("cluster"))
        .when(months < LOCAL_MONTHS, F.lit("blend"))
        .otherwise(F.lit("local"))
    )
    weight = F.when(phase == "cluster", 1.0).when(phase == "blend", BLEND_CLUSTER).when(phase == "local", 0.0)
    c, loc = F.col("cluster_mean"), F.col("local_mean")
    prediction = (
        F.when(c.isNull(), loc)
        .when(loc.isNull(), c)
        .otherwise(F.col("cluster_weight") * c + (1 - F.col("cluster_weight")) * loc)
    )
    return (
        joined.withColumn("phase", phase)
        .withColumn("cluster_weight", weight)
        .withColumn("prediction", F.when(F.col("phase").isNotNull(), prediction))
        .select(
            store, date, value, F.col("__cluster").alias(cluster), months.alias("months_open"),
            "phase", "cluster_mean", "local_mean", "cluster_weight", "prediction",
        )
    )
