"""Windowed counts of a stream with late data handled by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_quality(
    events: DataFrame,
    group: str = "event_type",
    value: str = "value",
    time: str = "ts",
    window: str = "1 day",
    lateness: str = "1 hour",
) -> DataFrame:
    """Per window and group: rows, missing values, negative values, mean. In append mode a window
    is emitted once, when the watermark passes its end; ``drain_updates`` gives open ones too."""
    typed = events.withColumn(time, F.col(time).cast("timestamp"))
    return (
        typed.withWatermark(time, lateness)
        .groupBy(F.window(time, window), group)
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col(value).isNull()).alias("missing_values"),
            F.count_if(F.col(value) < 0).alias("negative_values"),
            F.avg(value).alias("mean_value"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            group,
            "total_rows",
            "missing_values",
            "negative_values",
            "mean_value",
        )
    )
