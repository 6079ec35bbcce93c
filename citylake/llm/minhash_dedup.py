"""Operator 2: near-duplicate documents by a multi-index join of b-bit MinHash signatures.

A signature has ``CHUNKS`` chunks of ``SLOTS`` b-bit values. By the pigeonhole principle two signatures
that differ in at most ``CHUNKS * (ERRORS + 1) - 1`` values differ in at most ``ERRORS`` values of some
chunk. Every choice of ``ERRORS`` values to leave out of a chunk gives one key, so all pairs within that
distance share a key. At a similarity of 0.8 a pair that shares no key has a chance of (1 - 0.737)**10 =
1.6e-6. Candidates are confirmed on their full shingle sets, and components come from ``linking``.

Equal sets (64-bit sums over their 64-bit shingle hashes) are one node from the start. A text without
words, or null, is linked with nothing. Rows that repeat, also with the same id, share a component; a
component's id is its smallest document id. Null ids belong to components but never name one unless all
are null. An empty table gives an empty result. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.linking import BlockLinks, attach, connect
from citylake.llm.storage import written
from citylake.llm.wordhash import ASCII_SPACE, FOLDED, batches, mix, shingles, words

CHUNKS, SLOTS, ERRORS, BITS = 10, 5, 1, 16
_KEPT = [list(c) for c in combinations(range(SLOTS), SLOTS - ERRORS)]
_RANDOM = np.random.default_rng(8127)
_FACTOR = _RANDOM.integers(0, 1 << 63, CHUNKS * SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 64, CHUNKS * SLOTS, dtype=np.uint64)
_CHUNK_SALT = mix(np.arange(1, CHUNKS * len(_KEPT) + 1, dtype=np.uint64)).reshape(CHUNKS, len(_KEPT))
_BLOCK = 4096


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    found = words(column, ~ASCII_SPACE, FOLDED)
    for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        yield np.unique(shingles(found.hash[lo:hi], size))


def fingerprint(shingle_set: np.ndarray) -> np.uint64:
    """One number for a set, whatever the order of its members."""
    return mix(mix(shingle_set).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingle_set)))[0]


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """Lowest bits of the least value under each hash function."""
    least = np.full(len(_FACTOR), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingle_set), _BLOCK):
        values = shingle_set[k : k + _BLOCK, None] * _FACTOR + _SHIFT
        np.minimum(least, values.min(axis=0), out=least)
    return mix(least) & np.uint64((1 << BITS) - 1)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """All keys of each signature (one a row): a chunk's values without ``ERRORS`` of them."""
    chunks = signatures.reshape(len(signatures), CHUNKS, SLOTS)
    keys = np.zeros((len(signatures), CHUNKS, len(_KEPT)), np.uint64)
    for k, kept in enumerate(_KEPT):
        for slot in kept:
            keys[:, :, k] = (keys[:, :, k] << np.uint64(BITS)) | chunks[:, :, slot]
    return (mix(keys) ^ _CHUNK_SALT).reshape(len(signatures), -1)


SKETCH = "doc_id bigint, n_shingles bigint, node bigint, keys array<bigint>"


def sketch(df: DataFrame, size: int, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: set size, fingerprint of its set, keys of its signature."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for lo, hi in batches(batch.column(1)):
                counts, prints, signatures = [], [], []
                for found in shingle_sets(batch.column(1).slice(lo, hi - lo), size):
                    counts.append(len(found))
                    prints.append(fingerprint(found))
                    signatures.append(signature(found))
                node = np.array(prints, np.uint64).view(np.int64)
                keys = chunk_keys(np.array(signatures, np.uint64)).view(np.int64)
                offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(node),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
                    names=["doc_id", "n_shingles", "node", "keys"],
                )

    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SKETCH)


def full_sets(texts: DataFrame, size: int) -> DataFrame:
    """``node`` and the whole set behind it as packed 64-bit numbers, for each row's ``text``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for lo, hi in batches(batch.column(0)):
                sets = list(shingle_sets(batch.column(0).slice(lo, hi - lo), size))
                nodes = np.array([fingerprint(s) for s in sets], np.uint64).view(np.int64)
                packed = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.record_batch([pa.array(nodes), packed], names=["node", "payload"])

    return texts.select("text").mapInArrow(run, "node bigint, payload binary")


def similar(pairs: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs with ``denominator * |A and B| >= numerator * |A or B|``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            sides = (batch.column("payload_a").to_pylist(), batch.column("payload_b").to_pylist())
            keep = []
            for a, b in zip(*sides):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if denominator * min(len(a), len(b)) < numerator * max(len(a), len(b)):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(denominator * both >= numerator * (len(a) + len(b) - both))
            ids = pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield ids.filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "payload_a", "payload_b").mapInArrow(run, "a bigint, b bigint")


def block_links(numerator: int, denominator: int) -> BlockLinks:
    """One link between each left set and each component among the others, where there is one."""

    def run(block: pa.Table) -> pa.Table:
        left = np.array(block.column("left").to_pylist(), bool)
        node, component = (block.column(c).to_numpy() for c in ("node", "component"))
        sets = [np.frombuffer(x, np.uint64) for x in block.column("payload").to_pylist()]
        size = np.array([len(x) for x in sets])
        # A block that meets itself comes as left rows only.
        rows, columns = np.flatnonzero(left), np.flatnonzero(~left)
        if not len(columns):
            columns = rows
        owner = np.repeat(np.arange(len(sets)), size)
        _, element = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(element, kind="stable")
        owner, element = owner[order], element[order]
        place = np.zeros((2, len(sets)), np.int64)
        place[0, rows], place[1, columns] = np.arange(len(rows)), np.arange(len(columns))
        is_row, is_column = np.zeros(len(sets), bool), np.zeros(len(sets), bool)
        is_row[rows], is_column[columns] = True, True
        both = np.zeros((len(rows), len(columns)), np.float32)
        last = int(element[-1]) + 1 if len(element) else 0
        for at in range(0, last, _BLOCK):  # shared elements counted by products of 0/1 matrices
            lo, hi = np.searchsorted(element, (at, at + _BLOCK))
            own, e = owner[lo:hi], element[lo:hi] - at
            x, y = np.zeros((len(rows), _BLOCK), np.float32), np.zeros((len(columns), _BLOCK), np.float32)
            x[place[0, own[is_row[own]]], e[is_row[own]]] = 1
            y[place[1, own[is_column[own]]], e[is_column[own]]] = 1
            both += x @ y.T
        both = both.astype(np.int64)
        union = size[rows][:, None] + size[columns] - both
        linked = (denominator * both >= numerator * union) & (component[rows][:, None] != component[columns])
        i, j = np.nonzero(linked)
        _, first = np.unique(np.stack((i, component[columns][j])), axis=1, return_index=True)
        a, b = node[rows[i[first]]], node[columns[j[first]]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def near_duplicates(
    df: DataFrame, size: int = 5, numerator: int = 80, denominator: int = 100, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``node``, ``component_id`` and ``kept``."""
    docs = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = written(sketch(docs, size), "sketches")
    some = sketches.where("n_shingles > 0")
    # Rows of one node have one set, so any row's keys are the node's.
    nodes = some.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.any_value("keys").alias("keys"), F.any_value("n_shingles").alias("weight")
    )
    nodes = written(nodes, "nodes")
    members = nodes.select("node", F.explode("keys").alias("key"))

    def payload(wanted: DataFrame) -> DataFrame:
        ids = attach(nodes.drop("keys", "weight"), wanted, "node").select(F.col("first_id").alias("doc_id"))
        named = full_sets(attach(docs, ids.distinct(), "doc_id"), size)
        unnamed = full_sets(docs.where("doc_id IS NULL"), size)
        return named.union(unnamed).dropDuplicates(["node"])

    groups, _ = connect(
        members, payload, lambda p: similar(p, numerator, denominator),
        block_links=block_links(numerator, denominator), traits=nodes.select("node", "weight"),
    )
    named = attach(nodes.select("node", "first_id"), groups, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = attach(named.select("node", "component"), smallest, "component").select("node", "component_id")
    linked = attach(sketches.drop("keys"), named, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    linked = linked.withColumn("component_id", component)
    return linked.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(df: DataFrame, size: int = 5, numerator: int = 80, denominator: int = 100, *,
                id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: the one with the smallest id. Documents without words stay.

    Rows that share the id of a kept row count as that document and stay with it.
    """
    found = near_duplicates(df, size, numerator, denominator, id=id, text=text)
    keys = found.where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return df.join(keys, df[id].cast("bigint").eqNullSafe(keys["kept_id"]), "left_semi")
