"""Language ID by a convolutional network over bytes, trained in numpy.

Bytes are folded to ``SYMBOLS`` symbols, embedded, and read by filters of two widths; a window's
features are the largest response of each filter, and a softmax layer gives its languages. A text
is the mean over its windows, weighted by their bytes, so every byte of every text counts.

The network is fitted on the driver on a bounded sample: at most about ``PER_LANGUAGE`` labelled
texts of each language, with ``PER_TEXT`` windows each. For prediction, embedding and filters are
multiplied out into one table of responses per three symbols, so a byte costs one table row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import tokens
from tallyloom.llm.quality_model import fold

WINDOW = 126
PER_LANGUAGE, PER_TEXT = 1500, 4
EMBEDDING, FILTERS = 8, {2: 8, 3: 24}
UNKNOWN = "und"

#: letters, white space, other ASCII, lead bytes, and continuation bytes in 11 groups
SYMBOLS = 40
_FOLD = np.full(256, 27, np.uint8)
_FOLD[tokens.SPACE] = 26
_FOLD[97:123] = _FOLD[65:91] = np.arange(26)
_FOLD[0x80:0xC0] = 29 + np.arange(64) % 11
_FOLD[0xC0:] = 28
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def windows(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram numbers of all windows (padded with SYMBOLS**3), their texts and their bytes.

    A trigram starts at every byte; beyond the end of a text stands white space.
    """
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    s = np.concatenate([_FOLD[buf], [26, 26]]).astype(np.int32)
    second, third = s[1:-1].copy(), s[2:].copy()
    filled = size > 0
    second[offsets[1:][filled] - 1] = third[offsets[1:][filled] - 1] = 26
    third[np.maximum(offsets[1:][filled] - 2, offsets[:-1][filled])] = 26
    trigram = (s[:-2] * SYMBOLS + second) * SYMBOLS + third
    first = np.concatenate([[0], np.cumsum(count)])
    flat = np.full(first[-1] * WINDOW, SYMBOLS**3, np.int32)
    flat[np.arange(len(buf)) + np.repeat(first[:-1] * WINDOW - offsets[:-1], size)] = trigram
    text = np.repeat(np.arange(len(size)), count)
    place = np.arange(first[-1]) - first[text]
    used = np.minimum(size[text] - place * WINDOW, WINDOW)
    return flat.reshape(-1, WINDOW), text, used


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, EMBEDDING, filters)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def table(self) -> np.ndarray:
        """Response of all filters to every trigram; the last row stands for no byte at all."""
        n, parts = SYMBOLS, []
        for width, f in self.filters.items():
            taps = [self.embedding @ f[k] for k in range(width)]
            shape = [taps[k].reshape([n if j == k else 1 for j in range(3)] + [-1]) for k in range(width)]
            parts.append(np.broadcast_to(sum(shape), (n, n, n, f.shape[2])).reshape(n**3, -1))
        rows = np.concatenate(parts, axis=1) + self.bias
        return np.concatenate([rows, np.full((1, rows.shape[1]), -1e9)]).astype(np.float32)

    def chances(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled, 0) @ self.out + self.out_bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def pool(table: np.ndarray, grams: np.ndarray, step: int = 256) -> np.ndarray:
    """Largest response of each filter in each window."""
    out = np.empty((len(grams), table.shape[1]), np.float32)
    for at in range(0, len(grams), step):
        out[at : at + step] = table.take(grams[at : at + step], axis=0).max(axis=1)
    return out


def train(grams: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, batch: int = 64, rate: float = 3e-3, seed: int = 5) -> Network:
    """Adam on cross-entropy; the largest response of each filter carries its gradient."""
    rng = np.random.default_rng(seed)
    total = sum(FILTERS.values())
    p = {"embedding": rng.normal(0, 0.5, (SYMBOLS, EMBEDDING)), "bias": np.zeros(total), "out_bias": np.zeros(len(languages))}
    p |= {f"f{w}": rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, n)) for w, n in FILTERS.items()}
    p["out"] = rng.normal(0, total**-0.5, (total, len(languages)))
    first, second, steps = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0

    def network():
        return Network(languages, p["embedding"], {w: p[f"f{w}"] for w in FILTERS}, p["bias"], p["out"], p["out_bias"])

    for _ in range(epochs):
        order = rng.permutation(len(grams))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            g, y = grams[chosen], labels[chosen]
            net = network()
            symbols = np.stack([g // SYMBOLS**2, g // SYMBOLS % SYMBOLS, g % SYMBOLS], axis=-1)
            absent = g == SYMBOLS**3
            symbols[absent] = 26
            x = p["embedding"][symbols]  # batch, window, 3, embedding
            responses = np.concatenate(
                [np.einsum("nlke,kef->nlf", x[:, :, :w], p[f"f{w}"], optimize=True) for w in FILTERS], axis=2
            ) + p["bias"]
            responses[absent] = -1e9
            best = responses.argmax(axis=1)  # batch, filters
            pooled = np.take_along_axis(responses, best[:, None], axis=1)[:, 0]
            d = net.chances(pooled)
            d[np.arange(len(y)), y] -= 1
            d /= len(y)
            active = np.maximum(pooled, 0)
            grads = {"out": active.T @ d, "out_bias": d.sum(axis=0)}
            back = (d @ p["out"].T) * (pooled > 0)
            grads["bias"], grads["embedding"], done = back.sum(axis=0), np.zeros_like(p["embedding"]), 0
            for w, n in FILTERS.items():
                where = best[:, done : done + n]
                rows = symbols[np.arange(len(y))[:, None], where][:, :, :w]  # batch, filters, width
                b = back[:, done : done + n]
                grads[f"f{w}"] = np.einsum("nfke,nf->kef", p["embedding"][rows], b)
                np.add.at(grads["embedding"], rows, np.einsum("nf,kef->nfke", b, p[f"f{w}"]))
                done += n
            steps += 1
            for k, v in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                p[k] -= rate * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)
    return network()


def sample_windows(docs: DataFrame, languages: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a stratified hash sample of ``docs`` (doc_id, text, lang) and their languages' numbers.

    ``languages``: texts of each language; from a language with many, a share is taken.
    """
    names = sorted(languages)
    million = 1_000_000
    limit = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(max(1, min(million, PER_LANGUAGE * million // languages[n]))))])
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(million)) < limit[F.col("lang")]).select("text", "lang")

    def run(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, end, buf, offsets in tokens.blocks(batch.column("text")):
                grams, text, _ = windows(buf, offsets)
                first = np.searchsorted(text, np.arange(end - at + 1))
                for d in range(end - at):
                    n = first[d + 1] - first[d]
                    if n:
                        # spread evenly over the whole text
                        picks = first[d] + np.unique(np.linspace(0, n - 1, PER_TEXT).astype(int))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([langs[at + d]] * len(picks)), pa.array([grams[i].tobytes() for i in picks], pa.binary())],
                            names=["lang", "grams"],
                        )

    rows = chosen.mapInArrow(run, "lang string, grams binary").collect()  # about PER_LANGUAGE * PER_TEXT per language
    rows.sort()
    number = {n: i for i, n in enumerate(names)}
    grams = np.frombuffer(b"".join(r["grams"] for r in rows), np.int32).reshape(-1, WINDOW)
    return grams, np.array([number[r["lang"]] for r in rows], np.int64)


def has_letter(texts: pa.Array, at: int, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    count = np.concatenate([[0], np.cumsum(_ASCII_LETTER[buf])])
    found = count[offsets[1:]] > count[offsets[:-1]]
    for d in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[d] = any(c.isalpha() for c in texts[at + int(d)].as_py() or "")
    return found


def languages(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score (chance of that language) per row of ``docs``.

    Learns from rows with an id outside fold ``held`` of its CRC-32 and a language. A NULL text
    and one without a letter are ``und`` with score 0, and so is every text if there is nothing
    to learn from. Repeated rows are predicted alike.
    """
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where(~held_out & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    net = table = None
    if counts:
        grams, labels = sample_windows(known.select("doc_id", "text", "lang"), counts)
        if len(grams):
            net = train(grams, labels, sorted(counts))
            table = net.table()

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for at, end, buf, offsets in tokens.blocks(texts):
                n = end - at
                names, score = np.full(n, UNKNOWN, object), np.zeros(n)
                if net is not None:
                    grams, text, used = windows(buf, offsets)
                    chances = net.chances(pool(table, grams))
                    total = np.zeros((n, len(net.languages)))
                    np.add.at(total, text, chances * used[:, None])
                    total /= np.maximum(np.diff(offsets), 1)[:, None]
                    some = has_letter(texts, at, buf, offsets)
                    best = total.argmax(axis=1)
                    names[some] = np.array(net.languages, object)[best[some]]
                    score[some] = np.clip(total.max(axis=1)[some], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), pa.array(names, pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"],
                )

    found = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
