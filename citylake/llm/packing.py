"""Operator 9: pack documents into as few token sequences as it can, by linear grouping.

Only a document longer than a sequence is cut, into pieces of a whole sequence and a rest. The counts of
the piece lengths (at most one per length) come to the driver, which plans runs of equal sequences
(``bin_plan``). Pieces find their place by their rank among all pieces of their length. Ranks come from
rows split by (length, bucket), so a length that holds most pieces is spread over ``BUCKETS`` groups.

Null texts count as empty and hold only the end id. Rows that repeat are packed each on its own. An
empty table gives an empty result. Other columns are ignored by ``pack``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.bin_plan import plan
from citylake.llm.storage import written
from citylake.llm.tokens import encoder
from citylake.llm.wordhash import batches

CAPACITY = 2048
BUCKETS = 256
GROUPS = 600
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(
    df: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document's ids, with the end id, in pieces of at most ``capacity``."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for lo, hi in batches(batch.column(1)):
                ids, offsets = encoder(tokenizer).encode(batch.column(1).slice(lo, hi - lo), end)
                size = np.diff(offsets)
                each = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), each)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                raw = memoryview(ids.astype("<u4")).cast("B")
                begin = (offsets[doc] + start) * 4
                crc = [zlib.crc32(raw[b : b + n]) for b, n in zip(begin.tolist(), (length * 4).tolist())]
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(doc)).cast(pa.int64()),
                     pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def pack(
    df: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, groups: int = GROUPS, *,
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every piece with its sequence and its offset there; sequences have no gaps."""
    cut = written(pieces(df, tokenizer, end, capacity, id=id, text=text), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most one row per length
        counts[length] = n
    runs = np.array(sorted(plan(counts, capacity, groups)), np.int64).reshape(-1, 5)

    # The bucket follows the ids too, so that only whole copies of a document tie.
    order = ("doc_id", "piece", "ids_crc32")
    split = cut.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)))
    group = Window.partitionBy("length", "bucket")
    before = Window.partitionBy("length").orderBy("bucket")
    sizes = split.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("size"))
    base = sizes.select("length", "bucket", (F.sum("size").over(before) - F.col("size")).alias("base"))
    ranked = split.withColumn("place", F.row_number().over(group.orderBy(*order))).join(base, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place") - 1).alias("rank")
    )

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Runs ascend by (length, rank); one number orders both.
        top = max(int(counts.max()), 1)
        keys = runs[:, 0] * top + runs[:, 1]
        for batch in parts:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = runs[np.searchsorted(keys, length * top + rank, side="right") - 1]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch(
                [*kept, pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id bigint, offset bigint")
