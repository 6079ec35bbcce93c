"""Operator 3: toxicity by a linear classifier over character n-grams scaled by naive Bayes ratios.

An n-gram is 4 to 6 bytes of the lower-case text within a word, its borders included; marks count as
borders. N-grams are hashed to ``BUCKETS`` features and count once per document. The log ratio of a
feature's frequency in toxic and other documents comes from all labelled training rows, and every feature
that occurs there has a weight. A logistic regression on the scaled features is fitted on at most
``SAMPLE`` training texts: the ``FEATURES`` features whose classes differ most have a factor of their own,
all others share one.

Null and empty texts have no n-grams and get the score of the intercept. Equal texts get equal scores.
Repeated labels count repeatedly; without labels of both classes every score is the smoothed share of
toxic ones. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.sampling import sample_texts
from citylake.llm.wordhash import ALNUM, batches, buffers, mix

BUCKETS = 1 << 18
SIZES = (4, 5, 6)
FEATURES = 5_000
SAMPLE = 12_000
SMOOTHING = 1.0
PENALTY = 1e-3
THRESHOLD = 0.7
_SALT = mix(np.arange(1, 9, dtype=np.uint64))


class Model(NamedTuple):
    """Weight per bucket and the intercept."""

    weight: np.ndarray
    intercept: float


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram, with repetitions."""
    data, offsets = buffers(pc.utf8_lower(column))
    # A border on both sides of every text.
    n = len(offsets) - 1
    text = np.full(len(data) + n + 1, 32, np.uint8)
    row = np.repeat(np.arange(n), np.diff(offsets))
    inside = np.arange(len(data)) + row + 1
    text[inside] = data
    alnum = ALNUM[text]
    text[~alnum] = 32
    at_row = np.zeros(len(text), np.int64)
    at_row[inside] = row
    gaps = np.concatenate(([0], np.cumsum(~alnum)))
    rows, found = [], []
    wide = text.astype(np.uint64)
    for size in SIZES:
        if len(text) < size:
            continue
        # No border within: all but the first and the last byte are word bytes.
        last = len(text) - size + 1
        at = np.flatnonzero(gaps[size - 1 : size - 1 + last] == gaps[1 : last + 1])
        code = np.full(len(at), size, np.uint64)
        for k in range(size):
            code = (code << np.uint64(8)) | wide[at + k]
        found.append((mix(code) & np.uint64(BUCKETS - 1)).astype(np.int64))
        rows.append(at_row[at + 1])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(found)


def class_counts(labelled: DataFrame) -> np.ndarray:
    """Documents with each bucket, per class (0, 1), over all rows ``text``, ``label``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in parts:
            for lo, hi in batches(batch.column("text")):
                row, bucket = ngrams(batch.column("text").slice(lo, hi - lo))
                label = batch.column("label").slice(lo, hi - lo).to_numpy()
                key = np.unique(row * BUCKETS + bucket)
                for c in (0, 1):
                    counts[c] += np.bincount(key[label[key // BUCKETS] == c] % BUCKETS, minlength=BUCKETS)
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.record_batch([pa.array(some), *map(pa.array, counts[:, some])], names=["bucket", "c0", "c1"])

    rows = labelled.select("text", "label").mapInArrow(run, "bucket bigint, c0 bigint, c1 bigint")
    total = rows.groupBy("bucket").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).toPandas()  # BUCKETS rows at most
    counts = np.zeros((2, BUCKETS))
    counts[:, total["bucket"]] = total[["c0", "c1"]].to_numpy().T
    return counts


def other_ratios(c0: np.ndarray, c1: np.ndarray, n0: float, n1: float) -> np.ndarray:
    """Log ratio of a feature's frequencies, 0 for one that never occurs, however unequal the classes are."""
    share = n1 / (n0 + n1)
    return np.log((c1 + SMOOTHING * share) / n1) - np.log((c0 + SMOOTHING * (1 - share)) / n0)


def sampled_features(labelled: DataFrame, chosen: np.ndarray, others: np.ndarray, limit: int):
    """Labels, chosen features (row, bucket) and sums of ``others`` by label, of at most ``limit`` texts, once per label."""
    sent = labelled.sparkSession.sparkContext.broadcast((chosen, others))  # BUCKETS numbers each

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, others = sent.value
        for batch in parts:
            for lo, hi in batches(batch.column("text")):
                row, bucket = ngrams(batch.column("text").slice(lo, hi - lo))
                key = np.unique(row * BUCKETS + bucket)
                label = batch.column("label").slice(lo, hi - lo).to_numpy()
                rest = np.bincount(key // BUCKETS, others[label[key // BUCKETS], key % BUCKETS], minlength=hi - lo)
                key = key[chosen[key % BUCKETS]]
                offsets = np.searchsorted(key, np.arange(hi - lo + 1) * BUCKETS)
                features = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(key % BUCKETS, pa.int32())
                )
                same = [batch.column(c).slice(lo, hi - lo) for c in ("h", "label")]
                yield pa.record_batch([*same, features, pa.array(rest)], names=["h", "label", "features", "rest"])

    some = sample_texts(labelled.select("text", "label"), limit)
    found = some.mapInArrow(run, "h bigint, label int, features array<int>, rest double").dropDuplicates(["h", "label"])
    found = found.toPandas().sort_values(["h", "label"])
    sizes = [len(x) for x in found["features"]]
    row = np.repeat(np.arange(len(found)), sizes)
    bucket = np.concatenate([*found["features"], np.zeros(0, np.int64)]).astype(np.int64)
    return found["label"].to_numpy(float), row, bucket, found["rest"].to_numpy(float)


def fit(labelled: DataFrame, limit: int = SAMPLE) -> Model:
    """Train on rows ``text``, ``label`` (0 or 1)."""
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((n1 + 1) / (n0 + 1))))
    c0, c1 = class_counts(labelled)
    ratio = np.log((c1 + SMOOTHING) / (c1 + SMOOTHING).sum()) - np.log((c0 + SMOOTHING) / (c0 + SMOOTHING).sum())
    share = (c0 + c1) / (n0 + n1)
    spread = np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1)) + 1e-9
    score = np.abs(c1 / n1 - c0 / n0) / spread
    chosen = np.zeros(BUCKETS, bool)
    chosen[np.argsort(-score, kind="stable")[:FEATURES]] = True
    chosen &= c0 + c1 > 1
    # A text's own count is left out of the ratios that it is fitted on.
    own = np.stack((
        other_ratios(np.maximum(c0 - 1, 0), c1, max(n0 - 1, 1), n1), other_ratios(c0, np.maximum(c1 - 1, 0), n0, max(n1 - 1, 1))
    ))
    own[:, chosen] = 0
    label, row, bucket, rest = sampled_features(labelled, chosen, own, limit)
    scale = (np.abs(rest).mean() if len(rest) else 0.0) + 1e-9
    rest = rest / scale
    names, column = np.unique(bucket, return_inverse=True)
    value, n = ratio[bucket], max(len(label), 1)
    weight, shared, intercept = np.zeros(len(names)), 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    # Full-batch Adam with an L2 penalty.
    moment, square, step = np.zeros(len(names) + 2), np.zeros(len(names) + 2), 0.05
    for turn in range(1, 401):
        odds = np.bincount(row, value * weight[column], minlength=n) + intercept
        odds = odds + shared * rest if len(label) else odds
        error = _sigmoid(odds) - label if len(label) else np.zeros(n)
        slope = np.bincount(column, value * error[row], minlength=len(names)) / n + PENALTY * weight
        common = (rest * error).mean() if len(label) else 0.0
        slope = np.concatenate((slope, [common + PENALTY * shared, error.mean()]))
        moment, square = 0.9 * moment + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        change = step * (moment / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
        weight, shared, intercept = weight - change[:-2], max(shared - change[-2], 0.0), intercept - change[-1]
    full = np.where(chosen, 0, shared / scale * other_ratios(c0, c1, n0, n1)).astype(np.float32)
    full[names] = weight * ratio[names]
    return Model(full, float(intercept))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def score(df: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, intercept = sent.value
        for batch in parts:
            for lo, hi in batches(batch.column(1)):
                row, bucket = ngrams(batch.column(1).slice(lo, hi - lo))
                keep = weight[bucket] != 0
                key = np.unique(row[keep] * BUCKETS + bucket[keep])
                odds = np.bincount(key // BUCKETS, weight[key % BUCKETS], minlength=hi - lo) + intercept
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(_sigmoid(odds))], names=["doc_id", "score"])

    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double")


def held_out(id: Column, parts: int, which: int) -> Column:
    """Whether an id belongs to the part that no model learns from."""
    return F.crc32(id.cast("string")) % parts == which
