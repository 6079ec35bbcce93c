"""Operator 5: find benchmark items in documents by SimHash windows.

Windows of exactly an item's number of words slide over each document. Windows and items have a 64-bit
SimHash of their words. Four 16-bit blocks with up to ``ERRORS`` wrong bits each, enumerated on the
item's side, meet in a join; by the pigeonhole principle every pair within ``RADIUS`` bits shares a key.
Candidates within the radius are verified by the Jaccard similarity of their shingles weighted by the
number of occurrences.

Only windows that can reach the similarity are hashed: that share of their shingles must be in a bitmap
of the items' shingles, by size. A bitmap has no misses, only chance hits, and a fixed size, so it may be
sent to every task however large the benchmark is.

Words are lower-case runs of letters and digits. Texts and items without words, or null, match nothing.
A document shorter than an item is one window if it is long enough to be similar. Rows that repeat are
reported once per id; null ids are reported as null. An empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.storage import written
from citylake.llm.wordhash import ALNUM, FOLDED, Words, batches, mix, shingles, words

SHINGLE = 5
PERCENT = 80
BLOCKS, WIDTH, ERRORS = 4, 16, 3
RADIUS = BLOCKS * (ERRORS + 1) - 1
MIN_BITS, MAX_BITS = 1 << 24, 1 << 28
_SIZE_SALT = np.uint64(0xA24BAED4963EE407)
_FLIPS = np.array([sum(1 << b for b in c) for k in range(ERRORS + 1) for c in combinations(range(WIDTH), k)], np.int64)

ITEMS = "item_id bigint, size int, sketch bigint, payload binary"
WINDOWS = "doc_id bigint, start int, size int, sketch bigint, payload binary"


def text_words(column: pa.Array) -> Words:
    return words(pc.utf8_lower(column), ALNUM, FOLDED)


def simhash(hashes: np.ndarray) -> np.ndarray:
    """SimHash of each row of word hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(*hashes.shape, 8), axis=-1, bitorder="little")
    major = bits.sum(axis=1, dtype=np.int64) * 2 > hashes.shape[1]
    return np.packbits(major, axis=-1, bitorder="little").view("<i8").ravel()


def item_sketches(items: DataFrame, id: str, text: str) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found, rows = text_words(batch.column(1)), []
            for key, lo, hi in zip(batch.column(0).to_pylist(), found.first[:-1], found.first[1:]):
                if hi > lo:
                    own = found.hash[lo:hi]
                    rows.append((key, hi - lo, simhash(own[None])[0], shingles(own, SHINGLE).tobytes()))
            if rows:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.record_batch(columns, names=["item_id", "size", "sketch", "payload"])

    rows = items.select(F.col(id).cast("bigint").alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, ITEMS)


def _by_size(hashes: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    return mix(hashes + _SIZE_SALT * np.asarray(size, np.uint64))


def _marks(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """Bitmap of the items' shingles, alone and with their item's size; the sizes that occur."""
    total = items.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits = MIN_BITS
    while bits < min(64 * total, MAX_BITS):
        bits *= 2

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(bits // 8, np.uint8)
        for batch in parts:
            for size, payload in zip(batch.column("size").to_pylist(), batch.column("payload").to_pylist()):
                own = np.frombuffer(payload, np.uint64)
                for at in (own, _by_size(own, size)):
                    at = at & np.uint64(bits - 1)
                    np.bitwise_or.at(marks, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield pa.record_batch({"marks": pa.array([marks.tobytes()], pa.binary())})

    marks = np.zeros(bits // 8, np.uint8)
    for row in items.select("size", "payload").coalesce(8).mapInArrow(run, "marks binary").toLocalIterator():
        marks |= np.frombuffer(row["marks"], np.uint8)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    return marks, sizes


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(marks) * 8 - 1)
    return (marks[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _needed(size: int, percent: int) -> int:
    """Fewest shingles of a window that must be an item's."""
    return -(-percent * (size - min(SHINGLE, size) + 1) // 100)


def candidate_windows(own: np.ndarray, hits: dict[int, np.ndarray], marks: np.ndarray, sizes: list[int], percent: int):
    """(starts, window length, item size) of the windows of one document that can be similar to an item."""
    for size in sizes:
        k = min(SHINGLE, size)
        at, need = hits[k], _needed(size, percent)
        if len(at) < need or 100 * len(own) < percent * size:
            continue
        grams = shingles(own, k) if len(own) >= k else own[:0]
        at = at[_marked(marks, _by_size(grams[at], size))]
        if len(at) < need:
            continue
        length = min(size, len(own))
        seen = np.zeros(len(grams) + 1, np.int64)
        seen[at + 1] = 1
        np.cumsum(seen, out=seen)
        inside = length - k + 1
        starts = np.flatnonzero(seen[inside:] - seen[:-inside] >= need)
        if len(starts):
            yield starts, length, size


def windows(df: DataFrame, marks: np.ndarray, sizes: list[int], percent: int, id: str, text: str) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(marks)  # at most MAX_BITS bits
    widths = sorted({min(SHINGLE, s) for s in sizes})
    fewest = {k: min(_needed(s, percent) for s in sizes if min(SHINGLE, s) == k) for k in widths}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sent.value
        for batch in parts:
            for lo, hi in batches(batch.column(1)):
                keys, found = batch.column(0).slice(lo, hi - lo), text_words(batch.column(1).slice(lo, hi - lo))
                doc = np.repeat(np.arange(hi - lo), np.diff(found.first))
                hits, some = {}, np.zeros(hi - lo, bool)
                for k in widths:
                    if len(doc) < k:
                        hits[k] = np.zeros(0, np.int64)
                        continue
                    at = np.flatnonzero(_marked(marks, shingles(found.hash, k)) & (doc[: len(doc) - k + 1] == doc[k - 1 :]))
                    hits[k] = at
                    some |= np.bincount(doc[at], minlength=hi - lo) >= fewest[k]
                for d in np.flatnonzero(some):
                    a, b = found.first[d], found.first[d + 1]
                    own = found.hash[a:b]
                    local = {k: v[np.searchsorted(v, a) : np.searchsorted(v, b)] - a for k, v in hits.items()}
                    for starts, length, size in candidate_windows(own, local, marks, sizes, percent):
                        step = max(1, (1 << 22) // (64 * length))
                        for j in range(0, len(starts), step):
                            part = starts[j : j + step]
                            inside = own[part[:, None] + np.arange(length)]
                            payload = [shingles(w, SHINGLE).tobytes() for w in inside]
                            n = len(part)
                            yield pa.record_batch(
                                [keys.take(pa.array(np.full(n, d))), pa.array(part, pa.int32()),
                                 pa.array(np.full(n, size), pa.int32()), pa.array(simhash(inside)),
                                 pa.array(payload, pa.binary())],
                                names=["doc_id", "start", "size", "sketch", "payload"],
                            )

    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, WINDOWS)


def _block(k: int):
    return F.shiftrightunsigned("sketch", WIDTH * k).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _window_keys() -> list:
    return [F.struct(F.lit(k).alias("block"), _block(k).alias("value")) for k in range(BLOCKS)]


def similar(pairs: DataFrame, percent: int) -> DataFrame:
    """Candidates whose shingles, counted with their occurrences, are similar enough."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            scores = []
            for a, b in zip(batch.column("payload").to_pylist(), batch.column("own").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                _, number = np.unique(np.concatenate((a, b)), return_inverse=True)
                n = int(number.max()) + 1
                a, b = np.bincount(number[: len(a)], minlength=n), np.bincount(number[len(a) :], minlength=n)
                scores.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
            score = np.array(scores, float)
            out = batch.select(["doc_id", "item_id", "start", "size"]).append_column("similarity", pa.array(score))
            yield out.filter(pa.array(score * 100 >= percent - 1e-9))

    schema = "doc_id bigint, item_id bigint, start int, size int, similarity double"
    return pairs.mapInArrow(run, schema)


def contaminated(
    df: DataFrame, benchmark: DataFrame, percent: int = PERCENT, *, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document and item found in it: the most similar window (first word, words) and its similarity."""
    items = written(item_sketches(benchmark, item_id, item_text), "items")
    marks, sizes = _marks(items)
    if not sizes:
        schema = "doc_id bigint, item_id bigint, start int, size int, similarity double"
        return df.sparkSession.createDataFrame([], schema)
    found = windows(df, marks, sizes, percent, id, text)
    found = written(found.withColumn("window", F.xxhash64("doc_id", "start", "size", "sketch")), "windows")
    flips = F.array(*[F.lit(int(m)) for m in _FLIPS])
    item_keys = items.select(
        "item_id", "size", F.col("sketch").alias("item_sketch"), F.explode(F.array(*_window_keys())).alias("k")
    ).select("item_id", "size", "item_sketch", F.col("k.block").alias("block"),
             F.explode(F.transform(flips, lambda m: F.col("k.value").bitwiseXOR(m))).alias("value"))
    window_keys = found.withColumn("k", F.explode(F.array(*_window_keys())))
    window_keys = window_keys.select("window", "size", "sketch", F.col("k.block").alias("block"),
                                     F.col("k.value").alias("value"))
    near = window_keys.join(item_keys, ["size", "block", "value"])
    near = near.where(F.bit_count(F.col("sketch").bitwiseXOR(F.col("item_sketch"))) <= RADIUS)
    pairs = found.join(near.select("window", "item_id").distinct(), "window")
    owns = items.select(F.col("item_id").alias("i"), F.col("size").alias("s"), F.col("payload").alias("own"))
    pairs = pairs.join(owns, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("size") == F.col("s"))).drop("i", "s")
    best = F.struct("similarity", (-F.col("start")).alias("first"), "size")
    hits = similar(pairs, percent).groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
    return hits.select("doc_id", "item_id", (-F.col("best.first")).alias("start_word"),
                       F.col("best.size").alias("n_words"), F.col("best.similarity").alias("similarity"))


def decontaminate(df: DataFrame, benchmark: DataFrame, percent: int = PERCENT, *, id: str = "doc_id", text: str = "text",
                  **options) -> DataFrame:
    """``df`` without the documents that contain a benchmark item."""
    found = contaminated(df, benchmark, percent, id=id, text=text, **options)
    found = found.select(F.col("doc_id").alias("found_id")).distinct()
    return df.join(found, df[id].cast("bigint").eqNullSafe(found["found_id"]), "left_anti")
