"""Quality classifier: random Fourier features of text statistics, ridge regression, isotonic scores.

Statistics of every whole text are computed once, in tasks, and written as a narrow table. The
labelled rows are mapped to random cosine features (an approximate Gaussian kernel); each partition
adds up its part of the normal equations, the parts are summed by Spark, and only the sums, whose
size is fixed by ``FEATURES``, are solved on the driver. The raw scores of the labelled rows are
summed per score bin for the isotonic fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import tokens
from tallyloom.sources.staging import stage

FEATURES = 256
WIDTH = 4.0  # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3  # per labelled row
BINS = 2000
PARTS = 64  # most partitions that send sums
CUT = 0.3

_ALL = np.arange(256)
_CLASSES = np.stack(
    [
        tokens.SPACE,
        (_ALL >= 65) & (_ALL <= 90),
        (_ALL >= 97) & (_ALL <= 122),
        (_ALL >= 48) & (_ALL <= 57),
        np.isin(_ALL, [ord(c) for c in "#*$%&|<>"]),
        np.isin(_ALL, [ord(c) for c in ".,;:?"]),
        _ALL == ord("!"),
        _ALL == ord("\n"),
        _ALL >= 0x80,
    ]
)
STATISTICS = len(_CLASSES) + 9


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text; ratios of nothing are 0."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    per = np.maximum(size, 1)
    columns = []
    for members in _CLASSES:
        columns.append(_sums(members[buf], offsets) / per)
    starts, ends, first = tokens.spans(buf, offsets, tokens.NOT_SPACE)
    words = np.diff(first).astype(float)
    per_word = np.maximum(words, 1)
    lengths = (ends - starts).astype(float)
    mean = _sums(lengths, first) / per_word
    spread = np.sqrt(np.maximum(_sums(lengths**2, first) / per_word - mean**2, 0))
    hashes = tokens.word_hashes(buf, starts, ends)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][words > 0]] = False
    different, most = np.zeros(n), np.zeros(n)
    for d in np.flatnonzero(words > 0):
        h = np.sort(hashes[first[d] : first[d + 1]])
        runs = np.diff(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]])))
        different[d], most[d] = len(runs), runs.max()
    last = buf[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    columns += [
        np.log1p(size),
        np.log1p(words),
        mean,
        np.minimum(spread, 50),
        _sums(again, first) / per_word,
        different / per_word,
        most / per_word,
        _sums(lengths == 1, first) / per_word,
        _sums(_CLASSES[4][last], first) / per_word,
    ]
    return np.stack(columns, axis=1)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of the whole text; NULL counts as empty."""

    def run(batches):
        for batch in batches:
            for at, end, buf, offsets in tokens.blocks(batch.column(1)):
                x = statistics(buf, offsets)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), lists], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<double>")


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string")) % n


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # random frequencies
    phases: np.ndarray
    beta: np.ndarray
    knots: np.ndarray = None
    levels: np.ndarray = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The closest non-decreasing sequence: neighbouring blocks that decrease are pooled."""
    means, weights, sizes = [], [], []
    for v, w in zip(value, weight):
        means.append(v)
        weights.append(w)
        sizes.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            w = weights[-2] + weights[-1]
            means[-2] = (means[-2] * weights[-2] + means[-1] * weights[-1]) / w
            weights[-2], sizes[-2] = w, sizes[-2] + sizes[-1]
            means.pop(), weights.pop(), sizes.pop()
    return np.repeat(means, sizes)


def _matrix(frame: pd.Series) -> np.ndarray:
    return np.stack(frame.to_numpy()) if len(frame) else np.zeros((0, STATISTICS))


def fit(labelled: DataFrame, features: int = FEATURES, seed: int = 7) -> Model | None:
    """Model of the rows (x, y with y 0 or 1); None without rows."""
    columns = [F.get("x", F.lit(i)) for i in range(STATISTICS)]
    moments = labelled.agg(F.count(F.lit(1)), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    if not moments[0]:
        return None
    spread = np.array(moments[1 + STATISTICS :], float)
    rng = np.random.default_rng(seed)
    model = Model(
        np.array(moments[1 : 1 + STATISTICS], float),
        np.where(spread > 1e-9, spread, 1.0),
        rng.normal(0, 1 / WIDTH, (STATISTICS, features)),
        rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
    )

    def partial(frames):
        total = np.zeros((features + 2, features + 1))
        for frame in frames:
            z = model.features(_matrix(frame["x"]))
            total[:-1] += z.T @ z
            total[-1] += z.T @ frame["y"].to_numpy(float)
        yield pd.DataFrame({"i": np.arange(features + 2, dtype=np.int32), "v": list(total)})

    parts = labelled.coalesce(PARTS).mapInPandas(partial, "i int, v array<double>")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((features + 2, features + 1))
    for r in cells.toLocalIterator():  # (features + 2) * (features + 1) sums
        total[r["i"], r["j"]] = r["v"]
    penalty = RIDGE * moments[0] * np.eye(features + 1)
    penalty[-1, -1] = 0
    model.beta = np.linalg.solve(total[:-1] + penalty + 1e-9 * np.eye(features + 1), total[-1])

    def binned(frames):
        for frame in frames:
            at = np.clip(np.round((model.raw(_matrix(frame["x"])) + 0.5) * BINS / 2), 0, BINS)
            yield pd.DataFrame({"bin": at.astype(np.int32), "y": frame["y"].astype("int64")})

    rows = labelled.mapInPandas(binned, "bin int, y long").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    table = sorted((r["bin"], r["n"], r["y"]) for r in rows.collect())  # at most BINS + 1
    n = np.array([r[1] for r in table], float)
    model.knots = np.array([r[0] for r in table]) * 2 / BINS - 0.5
    model.levels = isotonic(np.array([r[2] for r in table]) / n, n)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``.

    Learns from labelled rows outside fold ``held`` of the id's CRC-32; rows without id are scored
    and not learned from. NULL and empty texts are scored by their (empty) statistics. Without
    labelled rows every score is 0.5.
    """
    table = stage(text_statistics(docs), "text-statistics")
    train = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    train = train.where(fold(F.col("doc_id"), folds) != held)
    model = fit(stage(table.join(train, "doc_id").select("x", "y"), "labelled"))

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, STATISTICS)
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = table.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
