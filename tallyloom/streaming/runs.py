"""Opening a file stream and draining it into a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files as a stream. ``files_per_batch`` bounds a micro-batch, and with it what one
    key can bring into one task."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Process what has arrived and stop; a later call with the same checkpoint continues."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def drain_updates(stream: DataFrame, out: str, checkpoint: str, keys: list[str], end: str) -> tuple[DataFrame, int]:
    """Process what has arrived and stop; return the latest row of every key, and the late rows.

    Rows of open groups are returned as well: is_final says whether the watermark has passed
    the time in column ``end``, so that the row can't change any more. Late rows are those that
    this run dropped because their group was closed. A batch that is run again replaces its rows.
    """

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (
        stream.writeStream.foreachBatch(keep)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    watermark = max((p["eventTime"].get("watermark", "") for p in progress), default="")
    spark = stream.sparkSession
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(out)
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "batch").alias("row")).select("row.*")
    final = F.col(end) <= F.to_timestamp(F.lit(watermark or None))
    return latest.withColumn("is_final", F.coalesce(final, F.lit(False))), late
