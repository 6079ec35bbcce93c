"""Operator 4: repeated passages by paragraph MinHash banding.

A paragraph is a line of at least ``MIN_WORDS`` words. Its shingle set has a MinHash signature in bands,
tuned to the fewest that reach ``RECALL`` at the similarity. Paragraphs that share a band meet in
``linking``, are verified by the exact Jaccard similarity of their sets, and form groups by components.

A repeated passage need not fill a line. So each document is also cut, whatever its lines, where the hash
of two words is least among ``REACH`` neighbours on both sides; equal passages are cut alike. These
pieces have one band, their whole text. Neighbouring pieces that recur in other documents form passages
of at least ``PASSAGE_WORDS`` words.

One row per occurrence in a group that spans several documents: the first by document id stays
(``kept``), the others are removals. Null and empty texts have no paragraphs. Rows equal in id and text
count as one document; null ids come first. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.linking import attach, connect
from citylake.llm.minhash_dedup import block_links, fingerprint, similar
from citylake.llm.storage import written
from citylake.llm.wordhash import ALNUM, FOLDED, batches, mix, shingles, words

MIN_WORDS = 20
SHINGLE = 5
NUMERATOR, DENOMINATOR = 80, 100
ROWS, RECALL = 3, 0.999
REACH = 5
PASSAGE_WORDS = 16
UNITS = "doc_id bigint, row_key bigint, start int, n_words int, node bigint, keys array<bigint>"


def bands_for(similarity: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """Fewest bands of ``rows`` values in which a pair of this similarity meets with chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


BANDS = bands_for(NUMERATOR / DENOMINATOR)
_DRAW = np.random.default_rng(4401)
_FACTOR = _DRAW.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _DRAW.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
_BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def band_keys(shingle_set: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingle_set), 4096):
        np.minimum(least, (shingle_set[k : k + 4096, None] * _FACTOR + _SHIFT).min(axis=0), out=least)
    keys = _BAND_SALT.copy()
    for row in least.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def cuts(hashes: np.ndarray) -> np.ndarray:
    """Word positions where pieces begin: the first strict minimum within ``REACH`` on both sides."""
    pairs = shingles(hashes, 2)
    n = len(pairs)
    if n < 2 * REACH + 1:
        return np.zeros(0, np.int64)
    spans = np.lib.stride_tricks.sliding_window_view(pairs, 2 * REACH + 1)
    return np.flatnonzero(spans.argmin(axis=1) == REACH) + REACH


def _texts(df: DataFrame, id: str, text: str) -> DataFrame:
    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")


def units(df: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Paragraphs, with band keys, and pieces, without, of every text; ``start`` counts words."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for lo, hi in batches(batch.column(2), 1 << 20):
                found = words(batch.column(2).slice(lo, hi - lo), ALNUM, FOLDED)
                line = np.searchsorted(np.flatnonzero(found.data == 10), found.start)
                doc, start, size, node, keys, has_keys = [], [], [], [], [], []
                for d, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist())):
                    own = found.hash[a:b]
                    edge = np.flatnonzero(np.diff(line[a:b], prepend=-1)) if b > a else np.zeros(0, np.int64)
                    for s, e in zip(edge.tolist(), [*edge[1:].tolist(), b - a]):
                        if e - s >= MIN_WORDS:
                            shingle_set = np.unique(shingles(own[s:e], SHINGLE))
                            doc.append(d), start.append(s), size.append(e - s)
                            node.append(fingerprint(shingle_set))
                            keys.append(band_keys(shingle_set)), has_keys.append(True)
                    at = cuts(own)
                    if len(at) > 1:
                        # Hash of each piece: the sum of its words' hashes at their places in it.
                        inside = np.arange(at[0], at[-1])
                        length = np.diff(at)
                        place = inside - np.repeat(at[:-1], length)
                        sums = np.add.reduceat(mix(own[at[0] : at[-1]] + mix(place.astype(np.uint64))), at[:-1] - at[0])
                        doc.extend([d] * len(length)), start.extend(at[:-1].tolist()), size.extend(length.tolist())
                        node.extend(mix(sums + length.astype(np.uint64))), has_keys.extend([False] * len(length))
                flags = np.array(has_keys, bool)
                offsets = np.concatenate(([0], np.cumsum(flags * BANDS))).astype(np.int32)
                flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
                at = pa.array(np.array(doc, np.int64))
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo).take(at), batch.column(1).slice(lo, hi - lo).take(at),
                     pa.array(start, pa.int32()), pa.array(size, pa.int32()),
                     pa.array(np.array(node, np.uint64).view(np.int64)), lists],
                    names=["doc_id", "row_key", "start", "n_words", "node", "keys"],
                )

    return _texts(df, id, text).mapInArrow(run, UNITS)


def _sets_at(texts: DataFrame) -> DataFrame:
    """``node`` and set of each paragraph listed in ``at`` (``start``, ``n_words``, ``node``)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for lo, hi in batches(batch.column(0)):
                found = words(batch.column(0).slice(lo, hi - lo), ALNUM, FOLDED)
                node, packed = [], []
                for a, wanted in zip(found.first[:-1].tolist(), batch.column(1).slice(lo, hi - lo).to_pylist()):
                    for w in wanted:
                        own = found.hash[a + w["start"] : a + w["start"] + w["n_words"]]
                        node.append(w["node"]), packed.append(np.unique(shingles(own, SHINGLE)).tobytes())
                yield pa.record_batch([pa.array(node, pa.int64()), pa.array(packed, pa.binary())], names=["node", "payload"])

    return texts.select("text", "at").mapInArrow(run, "node bigint, payload binary")


def _grouped(rows: DataFrame, group: str) -> DataFrame:
    """Occurrences of groups in several documents, with the first place of the group."""
    place = F.struct("doc_id", "row_key", "start")
    several = rows.groupBy(group).agg(
        F.min(place).alias("first"), F.min("row_key").alias("lo"), F.max("row_key").alias("hi")
    ).where("lo < hi").select(group, "first")
    return attach(rows, several, group)


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_key") == F.col("first.row_key"))


def repeated_passages(df: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_key``, ``kind``, ``start_word``, ``n_words``, ``first_doc_id``, ``kept``."""
    every = written(units(df, id=id, text=text), "units")
    paragraphs = every.where("size(keys) > 0")
    place = F.struct("row_key", "start", "n_words")
    nodes = paragraphs.groupBy("node").agg(F.any_value("keys").alias("keys"), F.min(place).alias("at"))
    nodes = written(nodes, "paragraph-nodes")
    members = nodes.select("node", F.explode("keys").alias("key"))
    traits = nodes.select("node", F.col("at.n_words").cast("bigint").alias("weight"))

    def payload(wanted: DataFrame) -> DataFrame:
        at = attach(nodes.select("node", "at"), wanted, "node")
        at = at.groupBy("at.row_key").agg(F.collect_set(F.struct("at.start", "at.n_words", "node")).alias("at"))
        return _sets_at(attach(_texts(df, id, text), at, "row_key")).dropDuplicates(["node"])

    groups, _ = connect(
        members, payload, lambda p: similar(p, NUMERATOR, DENOMINATOR),
        block_links=block_links(NUMERATOR, DENOMINATOR), traits=traits,
    )
    named = attach(paragraphs.drop("keys"), groups, "node", "left")
    named = named.withColumn("group", F.coalesce("component", "node"))
    lines = _grouped(named, "group").select(
        "doc_id", "row_key", F.lit("paragraph").alias("kind"), F.col("start").alias("start_word"), "n_words",
        F.col("first.doc_id").alias("first_doc_id"),
        (_same_document() & (F.col("start") == F.col("first.start"))).alias("kept"),
    )

    pieces = _grouped(every.where("size(keys) = 0"), "node").withColumn("kept", _same_document())
    # Neighbouring pieces with one verdict; a window holds the repeated pieces of one document.
    along = Window.partitionBy("row_key", "doc_id").orderBy("start")
    new = F.coalesce(
        (F.lag("start").over(along) + F.lag("n_words").over(along) != F.col("start")) | (F.lag("kept").over(along) != F.col("kept")),
        F.lit(True),
    )
    pieces = pieces.dropDuplicates(["doc_id", "row_key", "start"]).withColumn("new", new.cast("int"))
    runs = pieces.withColumn("run", F.sum("new").over(along)).groupBy("doc_id", "row_key", "run", "kept").agg(
        F.min("start").alias("start_word"), F.sum("n_words").cast("int").alias("n_words"),
        F.min("first.doc_id").alias("first_doc_id"),
    ).where(F.col("n_words") >= PASSAGE_WORDS)
    passages = runs.withColumn("kind", F.lit("passage")).select(lines.columns)
    return lines.union(passages)
