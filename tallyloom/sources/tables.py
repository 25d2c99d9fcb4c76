"""Readers and writers of raw tables, feature tables, forecasts and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.schemas import RAW_TABLES


def _nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats}) if floats else df


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; NaN becomes NULL once, here."""
    return _nan_to_null(spark.read.schema(schema).option("header", True).csv(path))


def read_raw_tables(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    schemas: Mapping[str, T.StructType] = RAW_TABLES,
) -> dict[str, DataFrame]:
    """The raw tables of a folder, ``<folder>/<name>.<fmt>`` each."""
    if fmt == "csv":
        return {n: read_csv_table(spark, f"{folder}/{n}.csv", s) for n, s in schemas.items()}
    return {n: spark.read.schema(s).format(fmt).load(f"{folder}/{n}.{fmt}") for n, s in schemas.items()}


def write_raw_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).format(fmt).save(f"{folder}/{name}.{fmt}")


def write_features(df: DataFrame, folder: str, version: str = "v1", partition_by: str = "year") -> str:
    """Feature table under a versioned path, partitioned so a time filter skips folders."""
    path = f"{folder}/features/version={version}"
    df.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return path


def read_features(
    spark: SparkSession, folder: str, version: str = "v1", columns: list[str] | None = None
) -> DataFrame:
    """Feature table of one version. Pass ``columns`` (the written order) to restore the
    position of the partition column, which parquet folders move to the end."""
    df = spark.read.parquet(f"{folder}/features/version={version}")
    return df.select(columns) if columns else df


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    (df.select(columns) if columns else df).write.mode("overwrite").option("header", True).csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """JSON lines with nested structs; NaN is written as null and null fields are kept."""
    _nan_to_null(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
