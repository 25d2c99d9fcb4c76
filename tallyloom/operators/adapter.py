"""Per-store correction of a global model by the shrunken mean residual."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.metrics import accuracy
from tallyloom.settings import ModelSettings


def fit_adapters(
    scored: DataFrame,
    settings: ModelSettings = ModelSettings(),
    store: str = "store_id",
    actual: str = "sales_amount",
    prediction: str = "prediction",
) -> DataFrame:
    """Table (store, mean_residual, std_residual, data_points) of stores with enough rows."""
    residual = F.col(actual) - F.col(prediction)
    return (
        scored.groupBy(store)
        .agg(
            F.avg(residual).alias("mean_residual"),
            F.stddev_samp(residual).alias("std_residual"),
            F.count(F.lit(1)).alias("data_points"),
        )
        .filter(F.col("data_points") >= settings.min_adapter_rows)
    )


def apply_adapters(
    scored: DataFrame,
    adapters: DataFrame,
    settings: ModelSettings = ModelSettings(),
    store: str = "store_id",
    prediction: str = "prediction",
    name: str = "adapted_prediction",
) -> DataFrame:
    """Add the adapted prediction, never negative, and whether an adapter was used.

    The shift is the mean residual times the shrinkage, scaled down for stores with less
    than ``rich_days`` rows. A store without an adapter keeps the global prediction.
    """
    joined = scored.join(adapters.select(store, "mean_residual", "data_points"), store, "left")
    confidence = F.least(F.col("data_points") / F.lit(float(settings.rich_days)), F.lit(1.0))
    shift = F.lit(settings.shrinkage) * confidence * F.col("mean_residual")
    value = F.col(prediction) + F.coalesce(shift, F.lit(0.0))
    return joined.withColumns(
        {
            name: F.greatest(F.lit(0.0), value),
            "prediction_type": F.when(F.col("data_points").isNotNull(), "adapted").otherwise("global_only"),
        }
    ).drop("mean_residual", "data_points")


def compare_models(
    scored: DataFrame,
    actual: str = "sales_amount",
    global_prediction: str = "prediction",
    adapted_prediction: str = "adapted_prediction",
) -> DataFrame:
    """One row of global and adapted accuracy over rows with positive sales, and row counts."""
    y, valid = F.col(actual), F.coalesce(F.col(actual) > 0, F.lit(False))
    measures = scored.agg(
        *accuracy(y, F.col(global_prediction), valid, "global_"),
        *accuracy(y, F.col(adapted_prediction), valid, "adapted_"),
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(valid).alias("valid_samples"),
    )
    return measures.withColumns(
        {
            "mape_reduction": F.col("global_mape") - F.col("adapted_mape"),
            "zero_sales_samples": F.col("total_samples") - F.col("valid_samples"),
        }
    )
