"""CUSUM per key over a stream, as a Spark job per micro-batch with a table of carried sums.

Every micro-batch runs the block form of the batch CUSUM (one task per key and time block, so a
key with a third of all events is spread over its blocks), starting each key from the sums that
earlier batches carried. The carried sums live in a versioned table: after batch b, version b
holds, for every key seen so far, both sums and the time and id of its last row. Batch b reads
version b - 1 and writes its output rows and version b, each replacing what a run of the same
batch wrote before, so a batch that is run again after a failure changes nothing.

Input columns other than key, time, id and value are not read; the carried table names its
columns carried_key, pos0, neg0, last_time, last_id. Rows not newer (by time, then id) than their key's last carried row are late: they are passed on
with ``is_late`` and without sums, and change nothing. Rows of a NULL key form a key of their own.
Inside one micro-batch rows are ordered by time and id, so none of them is late against another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.cusum import cusum_series_in_blocks
from tallyloom.settings import CUSUM_SLACK, CUSUM_THRESHOLD

SUMS = ("cusum_pos", "cusum_neg", "drift_detected", "direction")


def _carried_schema(key_type: T.DataType, time_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("carried_key", key_type),
            T.StructField("pos0", T.DoubleType()),
            T.StructField("neg0", T.DoubleType()),
            T.StructField("last_time", time_type),
            T.StructField("last_id", T.LongType()),
        ]
    )


def carried_sums(spark: SparkSession, folder: str, version: int, schema: T.StructType) -> DataFrame:
    """The carried sums after batch ``version`` (none before the first batch)."""
    if version < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/carried/version={version}")


def cusum_batch(
    rows: DataFrame,
    before: DataFrame,
    key: str,
    value: str,
    time: str,
    row_id: str,
    block: Column,
    target: float = 0.0,
    slack: float = CUSUM_SLACK,
    threshold: float = CUSUM_THRESHOLD,
) -> DataFrame:
    """Output rows of one micro-batch, from the carried sums ``before`` it."""
    rows = rows.select(key, time, F.col(row_id).cast("bigint").alias(row_id), F.col(value).cast("double").alias(value))
    marked = rows.join(before, rows[key].eqNullSafe(before["carried_key"]), "left")
    newer = (F.col(time) > F.col("last_time")) | ((F.col(time) == F.col("last_time")) & (F.col(row_id) > F.col("last_id")))
    marked = marked.withColumn("is_late", F.col("last_time").isNotNull() & ~F.coalesce(newer, F.lit(False)))
    fresh = marked.where(~F.col("is_late")).select(
        key, time, row_id, value, F.coalesce("pos0", F.lit(0.0)).alias("pos0"), F.coalesce("neg0", F.lit(0.0)).alias("neg0")
    )
    summed = cusum_series_in_blocks(
        fresh, [key], [time, row_id], value, block, target, slack, threshold, start=("pos0", "neg0")
    ).select(key, time, row_id, value, *SUMS, F.lit(False).alias("is_late"))
    late = marked.where("is_late").select(
        key, time, row_id, value, *(F.lit(None).cast(summed.schema[c].dataType).alias(c) for c in SUMS), "is_late"
    )
    return summed.unionByName(late)


def carried_after(out: DataFrame, before: DataFrame, key: str, time: str, row_id: str) -> DataFrame:
    """The carried sums after a batch: its written output rows over the sums before it."""
    last = out.where(~F.col("is_late")).groupBy(key).agg(F.max(F.struct(time, row_id, "cusum_pos", "cusum_neg")).alias("last"))
    last = last.select(
        F.col(key).alias("carried_key"),
        F.col("last.cusum_pos").alias("pos0"),
        F.col("last.cusum_neg").alias("neg0"),
        F.col(f"last.{time}").alias("last_time"),
        F.col(f"last.{row_id}").alias("last_id"),
    )
    kept = before.join(last, before["carried_key"].eqNullSafe(last["carried_key"]), "left_anti")
    return kept.unionByName(last)


def drain_cusum(
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    key: str,
    value: str,
    time: str = "ts",
    row_id: str = "event_id",
    block: Column | None = None,
    target: float = 0.0,
    slack: float = CUSUM_SLACK,
    threshold: float = CUSUM_THRESHOLD,
) -> DataFrame:
    """Process what has arrived and stop; return all output rows so far (a later call continues).

    ``block`` (default: the hour of ``time``) must not decrease with time; one block of the
    busiest key should fit a task.
    """
    step = batch_step(stream, folder, key, value, time, row_id, block, target, slack, threshold)
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/out")


def batch_step(
    stream: DataFrame,
    folder: str,
    key: str,
    value: str,
    time: str = "ts",
    row_id: str = "event_id",
    block: Column | None = None,
    target: float = 0.0,
    slack: float = CUSUM_SLACK,
    threshold: float = CUSUM_THRESHOLD,
):
    """The function that foreachBatch calls with a micro-batch and its number."""
    spark = stream.sparkSession
    block = F.date_trunc("hour", F.col(time)) if block is None else block
    schema = _carried_schema(stream.schema[key].dataType, stream.schema[time].dataType)

    def step(rows: DataFrame, batch: int) -> None:
        before = carried_sums(spark, folder, batch - 1, schema)
        out = cusum_batch(rows, before, key, value, time, row_id, block, target, slack, threshold)
        out.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")
        written = spark.read.parquet(f"{folder}/out/batch={batch}")
        after = carried_after(written, before, key, time, row_id)
        after.write.mode("overwrite").parquet(f"{folder}/carried/version={batch}")

    return step
