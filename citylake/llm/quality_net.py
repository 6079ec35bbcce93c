"""Operator 7: document quality by random-indexing word vectors and a two-layer network.

Words are runs of letters and digits, and runs of marks, case kept, hashed to ``BUCKETS``. Each bucket
has a sparse random index vector. A word's vector is the sum of the index vectors of its neighbours
within ``REACH`` words, over all documents. A document is the mean and the spread of its words' unit
vectors. A network of one hidden layer is trained in numpy on at most ``SAMPLE`` labelled texts, and a
temperature fitted on a fifth of them calibrates its probabilities.

Null and empty texts have the zero vector and get its score. Equal texts get equal scores. Without labels
of both classes every score is the smoothed share of label 1. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.sampling import sample_texts
from citylake.llm.wordhash import ALNUM, EXACT, batches, mix, words

BUCKETS = 1 << 14
WIDTH = 32
REACH = 2
NONZERO = 2
HIDDEN = 32
SAMPLE = 20_000
THRESHOLD = 0.7
MARK = ~ALNUM
MARK[[0x20, *range(0x09, 0x0E)]] = False

_DRAW = mix(np.arange(1, BUCKETS * NONZERO + 1, dtype=np.uint64)).reshape(BUCKETS, NONZERO)
_PLACE = (_DRAW % np.uint64(WIDTH)).astype(np.int64)
_SIGN = np.where(_DRAW >> np.uint64(63) == 1, 1.0, -1.0)
VECTORS = "bucket int, " + ", ".join(f"v{k} double" for k in range(WIDTH))
FEATURES = 2 * WIDTH


def word_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words in order, and the first word of each text."""
    letters, marks = words(column, ALNUM, EXACT), words(column, MARK, EXACT)
    start = np.concatenate((letters.start, marks.start))
    bucket = (np.concatenate((letters.hash, marks.hash)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return bucket[np.argsort(start, kind="stable")], letters.first + marks.first


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """Unit vector per bucket, from the neighbours of all words of all texts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * WIDTH)
        for batch in parts:
            for lo, hi in batches(batch.column(0)):
                bucket, first = word_buckets(batch.column(0).slice(lo, hi - lo))
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                for reach in range(1, REACH + 1):
                    same = np.flatnonzero(row[reach:] == row[:-reach])
                    a, b = bucket[same], bucket[same + reach]
                    for x, y in ((a, b), (b, a)):
                        for k in range(NONZERO):
                            total += np.bincount(x * WIDTH + _PLACE[y, k], _SIGN[y, k], minlength=BUCKETS * WIDTH)
        total = total.reshape(BUCKETS, WIDTH)
        some = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(some, pa.int32()), *(pa.array(c) for c in total[some].T)]
        yield pa.record_batch(columns, names=["bucket", *(f"v{k}" for k in range(WIDTH))])

    rows = df.select(F.col(text).cast("string").alias("text")).mapInArrow(run, VECTORS)
    sums = [F.sum(f"v{k}").alias(f"v{k}") for k in range(WIDTH)]
    found = rows.groupBy("bucket").agg(*sums).toPandas()  # BUCKETS rows at most
    vectors = np.zeros((BUCKETS, WIDTH))
    vectors[found["bucket"]] = found[[f"v{k}" for k in range(WIDTH)]].to_numpy()
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the word vectors of each text."""
    bucket, first = word_buckets(column)
    out = np.zeros((len(first) - 1, FEATURES))
    step = 1 << 18
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for at in range(0, len(bucket), step):
        inside = vectors[bucket[at : at + step]]
        rows, begin = np.unique(row[at : at + step], return_index=True)
        out[rows, :WIDTH] += np.add.reduceat(inside, begin, axis=0)
        out[rows, WIDTH:] += np.add.reduceat(inside * inside, begin, axis=0)
    out /= np.maximum(np.diff(first), 1)[:, None]
    out[:, WIDTH:] = np.sqrt(np.maximum(out[:, WIDTH:] - out[:, :WIDTH] ** 2, 0))
    return out


class Network(NamedTuple):
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_shift: np.ndarray
    second: np.ndarray
    second_shift: float
    temperature: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.first + self.first_shift)
        return hidden @ self.second + self.second_shift

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.odds(x) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(odds: np.ndarray, label: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(label == 1, -odds, odds))))


def train(x: np.ndarray, label: np.ndarray, epochs: int = 60, size: int = 256) -> Network:
    draw = np.random.default_rng(11)
    if len(set(label.tolist())) < 2:
        odds = float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
        zero = np.zeros((FEATURES, HIDDEN))
        return Network(np.zeros(FEATURES), np.ones(FEATURES), zero, np.zeros(HIDDEN), np.zeros(HIDDEN), odds, 1.0)
    order = draw.permutation(len(x))
    check, learn = order[: len(x) // 5], order[len(x) // 5 :]
    centre, scale = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-6
    z = (x - centre) / scale
    parts = [draw.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    moment, square, turn = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(epochs):
        for at in np.array_split(draw.permutation(learn), max(1, len(learn) // size)):
            hidden = np.tanh(z[at] @ parts[0] + parts[1])
            error = (_sigmoid(hidden @ parts[2] + parts[3][0]) - label[at]) / len(at)
            back = error[:, None] * parts[2] * (1 - hidden**2)
            slopes = [z[at].T @ back + 1e-4 * parts[0], back.sum(axis=0), hidden.T @ error + 1e-4 * parts[2],
                      np.array([error.sum()])]
            turn += 1
            for k, slope in enumerate(slopes):
                moment[k] = 0.9 * moment[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope**2
                parts[k] = parts[k] - 3e-3 * (moment[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.999**turn)) + 1e-8)
    net = Network(centre, scale, *parts[:3], float(parts[3][0]), 1.0)
    if len(check):
        odds = net.odds(x[check])
        choices = np.geomspace(0.25, 8, 101)
        net = net._replace(temperature=float(min(choices, key=lambda t: _loss(odds / t, label[check]))))
    return net


def fit(labelled: DataFrame, vectors: np.ndarray, limit: int = SAMPLE) -> Network:
    """Train on at most ``limit`` different texts of rows ``text``, ``label`` (0 or 1)."""
    sent = labelled.sparkSession.sparkContext.broadcast(vectors)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for lo, hi in batches(batch.column(0)):
                x = pooled(batch.column(0).slice(lo, hi - lo), sent.value)
                offsets = pa.array(np.arange(len(x) + 1) * FEATURES, pa.int32())
                rest = [batch.column(c).slice(lo, hi - lo) for c in ("h", "label")]
                features = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
                yield pa.record_batch([*rest, features], names=["h", "label", "x"])

    some = sample_texts(labelled.select("text", "label"), limit)
    found = some.mapInArrow(run, "h bigint, label int, x array<double>").dropDuplicates(["h", "label"])
    found = found.toPandas().sort_values(["h", "label"])
    x = np.array(found["x"].tolist(), float).reshape(len(found), FEATURES)
    return train(x, found["label"].to_numpy(float))


def score(df: DataFrame, vectors: np.ndarray, net: Network, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    sent = df.sparkSession.sparkContext.broadcast((vectors, net))  # fixed size

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = sent.value
        for batch in parts:
            for lo, hi in batches(batch.column(1)):
                p = net.probability(pooled(batch.column(1).slice(lo, hi - lo), vectors))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(p)], names=["doc_id", "score"])

    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double")
