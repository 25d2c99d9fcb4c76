"""CUSUM per key over a stream, with the two sums as keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom.functions.rules import cusum_direction, cusum_drift
from tallyloom.operators.cusum import settled
from tallyloom.settings import CUSUM_SLACK, CUSUM_THRESHOLD

_STATE = T.StructType(
    [
        T.StructField("cusum_pos", T.DoubleType()),
        T.StructField("cusum_neg", T.DoubleType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField("last_id", T.LongType()),
    ]
)


def continue_cusum(x: np.ndarray, slack: float, pos: float, neg: float) -> tuple[np.ndarray, np.ndarray]:
    """Both sums after each deviation, starting from given sums."""
    up = pos + np.cumsum(x - slack)
    down = neg + np.cumsum(x + slack)
    return (
        up - np.minimum(0.0, np.minimum.accumulate(up)),
        down - np.maximum(0.0, np.maximum.accumulate(down)),
    )


def stream_cusum(
    events: DataFrame,
    key: str,
    value: str,
    time: str = "ts",
    row_id: str = "event_id",
    target: float = 0.0,
    slack: float = CUSUM_SLACK,
    threshold: float = CUSUM_THRESHOLD,
) -> DataFrame:
    """Append the sums and the drift flag to every event of a stream.

    Rows of a key are ordered by time and id inside a micro-batch, whose size the source
    option bounds. A row older than the key's last processed row cannot change sums that
    were already emitted: it is passed on with ``is_late`` and without sums. To restart a
    series, add a segment to the key. For a backlog with very long keys use the batch form
    in blocks.
    """
    rows = events.select(
        F.col(key), F.col(time).cast("timestamp").alias(time), F.col(row_id).cast("bigint").alias(row_id),
        F.col(value).cast("double").alias(value),
    )
    key_type = rows.schema[key].dataType
    out = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField(time, T.TimestampType()),
            T.StructField(row_id, T.LongType()),
            T.StructField(value, T.DoubleType()),
            T.StructField("cusum_pos", T.DoubleType()),
            T.StructField("cusum_neg", T.DoubleType()),
            T.StructField("is_late", T.BooleanType()),
        ]
    )

    def step(group: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(parts), ignore_index=True).sort_values([time, row_id], ignore_index=True)
        pos, neg = 0.0, 0.0
        late = np.zeros(len(batch), dtype=bool)
        if state.exists:
            pos, neg, last_time, last_id = state.get
            last_time = pd.Timestamp(last_time)
            late = ((batch[time] < last_time) | ((batch[time] == last_time) & (batch[row_id] <= last_id))).to_numpy()
        fresh = ~late
        up = np.full(len(batch), np.nan)
        down = np.full(len(batch), np.nan)
        if fresh.any():
            deviations = batch.loc[fresh, value].to_numpy() - target
            up[fresh], down[fresh] = continue_cusum(deviations, slack, pos, neg)
            newest = batch.loc[fresh].iloc[-1]
            state.update((float(up[fresh][-1]), float(down[fresh][-1]), newest[time].to_pydatetime(), int(newest[row_id])))
        batch["cusum_pos"], batch["cusum_neg"] = up, down
        batch["is_late"] = late
        yield batch[[f.name for f in out]]

    stateful = rows.groupBy(key).applyInPandasWithState(
        step, out, _STATE, "append", GroupStateTimeout.NoTimeout
    )
    pos, neg = (F.when(~F.col("is_late"), F.col(c)) for c in ("cusum_pos", "cusum_neg"))
    return stateful.withColumns(
        {
            "cusum_pos": pos,
            "cusum_neg": neg,
            "drift_detected": cusum_drift(settled(pos), settled(neg), threshold),
            "direction": F.when(pos.isNotNull(), cusum_direction(settled(pos), settled(neg))),
        }
    )
