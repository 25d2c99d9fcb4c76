"""A retail panel derived from order, supplier and region tables.

Stores are suppliers, brands nations, countries regions, and a day is a ship date.
Money is summed as decimals and turned to double last, so results do not depend on
the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.rules import history_tier
from tallyloom.operators.panel import densify
from tallyloom.operators.split import cut_rows, tag_by_cuts
from tallyloom.settings import SplitSettings
from tallyloom.sources.staging import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation and region names per nation key."""
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("country")
    )
    nations = table(spark, sf_dir, "nation").join(regions, "n_regionkey")
    return nations.select("n_nationkey", F.col("n_name").alias("brand_id"), "country")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales per store. Lines are summed per store and day before any join, so a
    store with many lines is already reduced to its days when it is shuffled by store."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"),
        F.to_date("l_shipdate").alias("date"),
        "l_orderkey",
        F.expr("cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))").alias("amount"),
        F.expr("cast(l_discount as decimal(4,2))").alias("discount"),
    )
    days = lines.groupBy("s_suppkey", "date").agg(
        F.sum("amount").cast("double").alias("sales_amount"),
        F.countDistinct("l_orderkey").alias("num_transactions"),
        F.max("discount").alias("discount"),
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return (
        days.join(suppliers, "s_suppkey")
        .join(_places(spark, sf_dir), "n_nationkey")
        .select(
            "date",
            F.col("s_suppkey").cast("bigint").alias("store_id"),
            "brand_id",
            "country",
            "sales_amount",
            "num_transactions",
            (F.col("sales_amount") / F.col("num_transactions")).alias("avg_transaction_value"),
            (F.col("discount") >= F.expr("0.05")).cast("int").alias("promotion_flag"),
            F.col("discount").cast("double").alias("promotion_discount"),
        )
    )


def sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a stored table, for plans that read it several times."""
    return stage(panel(spark, sf_dir), "sales")


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    history = (180 + (key * 37) % 1281).cast("int")
    return suppliers.join(_places(spark, sf_dir), "n_nationkey").select(
        key.cast("bigint").alias("store_id"),
        "brand_id",
        "country",
        F.when(key % 4 == 0, "mall")
        .when(key % 4 == 1, "street")
        .when(key % 4 == 2, "airport")
        .otherwise("online")
        .alias("location_type"),
        (50 + key % 451).cast("int").alias("store_size_sqm"),
        history.alias("history_days"),
        history_tier(history).alias("tier"),
    )


def brand_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("brand_id"),
        F.concat(F.lit("CAT_"), (key % 8).cast("string")).alias("category"),
        F.when(key % 3 == 0, "ultra_luxury").when(key % 3 == 1, "luxury").otherwise("premium").alias("price_tier"),
        (100 + (key * 199) % 4901).cast("int").alias("avg_price_point"),
    )


def external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily values per country from orders; covers fewer days than the panel."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.to_date("o_orderdate").alias("date"),
        F.expr("cast(o_totalprice as decimal(14,2))").alias("total"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"),
    )
    return (
        orders.join(customers, "o_custkey")
        .join(_places(spark, sf_dir), "n_nationkey")
        .groupBy("date", "country")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total").cast("double").alias("__total"),
            F.max("urgent").alias("is_public_holiday"),
        )
        .withColumn("demand_index", F.col("__total") / F.col("order_count"))
        .select("date", "country", "order_count", "demand_index", "is_public_holiday")
    )


def panel_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(
        stage(panel(spark, sf_dir).select("store_id", "date", "sales_amount"), "sales-days"),
        {"sales_amount": 0.0},
    )


def weekday_means(train: DataFrame) -> DataFrame:
    """Mean sales per brand and weekday: a global predictor that SQL can state as well."""
    return train.groupBy("brand_id", F.weekday("date").alias("__weekday")).agg(
        F.avg("sales_amount").alias("prediction")
    )


def predict_by_weekday(df: DataFrame, means: DataFrame) -> DataFrame:
    keyed = df.withColumn("__weekday", F.weekday("date"))
    return keyed.join(means, ["brand_id", "__weekday"], "left").drop("__weekday")


def scored_with_means(
    spark: SparkSession, sf_dir: str, settings: SplitSettings = SplitSettings()
) -> tuple[DataFrame, DataFrame]:
    """Stored panel with ``split`` and ``prediction``, and the predictor's table."""
    sales = sales_table(spark, sf_dir)
    cuts = stage(cut_rows(sales, [settings.train, settings.train + settings.val]), "cuts")
    parts = tag_by_cuts(sales, cuts, ["train", "val", "test"])
    means = stage(weekday_means(parts.filter(F.col("split") == "train")), "weekday-means")
    return predict_by_weekday(parts, means), means


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_with_means(spark, sf_dir)[0]

