"""Queries against the libraries and rules that their columns are defined by."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citylake.llm import packing, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_packed_pieces(spark):
    """Every piece of every document: ids, checksum, start, length; sequences without gaps, near the least number."""
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.word_tokenizer()
    library = tokenizers.Tokenizer.from_file(path)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "word " * 5000)]
    wanted, total = {}, 0
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            wanted[i, piece] = (start, len(part), zlib.crc32(part.tobytes()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = packing.pack(docs, path, end=0).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == wanted and len(found) == len(wanted)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held)])[:-1].tolist()
        assert sum(n for _, n in held) <= 2048
    assert len(places) <= math.ceil(total / 2048) * 1.03 + 1


def test_held_out_is_never_null(spark):
    """By the checksum of the id as text; a row without an id is no held-out row."""
    ids = [1, 2, 3, 40, 517, None]
    scores = spark.createDataFrame([(i, 0.7) for i in ids], "doc_id long, score double")
    for parts, which in ((3, 1), (4, 2)):
        got = {r.doc_id: r.held_out for r in queries._judged(scores, parts, which, 0.7).collect()}
        assert got == {i: i is not None and zlib.crc32(str(i).encode()) % parts == which for i in ids}


def test_training_split(spark):
    """Labels are learned from the rows that are not held out, by the checksum of the id."""
    ids = spark.range(50).select(F.col("id").alias("doc_id"))
    kept = {r.doc_id for r in ids.where(~toxicity.held_out(F.col("doc_id"), 3, 1)).collect()}
    assert kept == {i for i in range(50) if zlib.crc32(str(i).encode()) % 3 != 1}
