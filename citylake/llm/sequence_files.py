"""Operator 6: token ids as equal-length rows of Arrow stream files, with random access and masks.

Documents are range-partitioned by id; each partition becomes one file of record batches whose columns
are fixed-size lists, so row ``r`` of a mapped file is a slice of one buffer:

* ``input_ids``: ``length`` token ids, 16 bits wide if the vocabulary allows it, else 32;
* ``mask``: true at ids, false at the filling behind the last id of the file;
* ``ends``: true at the last id of a document.

A document index (``doc_id``, ``start``, ``n_tokens``, relative to the file) lies beside each file. Files
are written under another name and renamed, so a repeated task replaces its file by an equal one.

Null texts count as empty: only the end id. Null ids come first. Rows that repeat stay, next to each
other. An empty table gives no files and no rows. Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm.storage import filesystem
from citylake.llm.tokens import encoder
from citylake.llm.wordhash import batches

LENGTH = 2048
ROWS_PER_BATCH = 64
MANIFEST = "file string, part int, n_docs bigint, n_tokens bigint"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def row_schema(length: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("input_ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length)),
         ("ends", pa.list_(pa.bool_(), length))]
    )


class _SequenceWriter:
    """Cuts a run of ids into rows and writes them batch by batch."""

    def __init__(self, sink, length: int, id_type: pa.DataType):
        self.schema, self.length, self.id_type = row_schema(length, id_type), length, id_type
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids, self.ends, self.waiting = [], [], 0

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ids.append(ids)
        self.ends.append(ends)
        self.waiting += len(ids)
        if self.waiting >= self.length * ROWS_PER_BATCH:
            self._write(self.waiting // self.length * self.length)

    def _write(self, size: int, filling: int = 0) -> None:
        ids, ends = np.concatenate(self.ids), np.concatenate(self.ends)
        self.ids, self.ends, self.waiting = [ids[size:]], [ends[size:]], len(ids) - size
        mask = np.arange(size + filling) < size
        ids, ends = np.pad(ids[:size], (0, filling)), np.pad(ends[:size], (0, filling))
        columns = [pa.array(ids, self.id_type), pa.array(mask), pa.array(ends)]
        lists = [pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns]
        batch = pa.record_batch(lists, schema=self.schema)
        for k in range(0, batch.num_rows, ROWS_PER_BATCH):
            self.writer.write_batch(batch.slice(k, ROWS_PER_BATCH))

    def close(self) -> None:
        if self.waiting:
            self._write(self.waiting, -self.waiting % self.length)
        self.writer.close()


def write_sequences(
    df: DataFrame, folder: str, tokenizer: str, end: int, length: int = LENGTH, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write all documents in ascending id order; one row per file, itself kept in ``folder``/manifest."""
    vocabulary = max(encoder(tokenizer).whole.get_vocab().values()) + 1
    id_type = pa.uint16() if max(vocabulary, end + 1) <= 1 << 16 else pa.uint32()

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, fs_path = TaskContext.get().partitionId(), filesystem(folder)
        fs, root = fs_path
        name = f"part-{part:06d}"
        fs.create_dir(root, recursive=True)
        attempt = f"{root}/.{name}-{uuid.uuid4().hex}"
        out, keys, sizes = None, [], []
        for batch in parts:
            for lo, hi in batches(batch.column(1)):
                if out is None:
                    sink = fs.open_output_stream(f"{attempt}.arrow")
                    out = _SequenceWriter(sink, length, id_type)
                ids, offsets = encoder(tokenizer).encode(batch.column(1).slice(lo, hi - lo), end)
                ends = np.zeros(len(ids), bool)
                ends[offsets[1:] - 1] = True
                out.add(ids, ends)
                keys.append(batch.column(0).slice(lo, hi - lo))
                sizes.append(np.diff(offsets))
        if out is None:
            return
        out.close()
        sink.close()
        n_tokens = np.concatenate(sizes)
        index = pa.record_batch(
            [pa.concat_arrays(keys).cast(pa.int64()), pa.array(np.cumsum(n_tokens) - n_tokens), pa.array(n_tokens)],
            schema=INDEX,
        )
        with fs.open_output_stream(f"{attempt}.index") as sink, pa.ipc.new_file(sink, INDEX) as writer:
            writer.write_batch(index)
        for kind in ("index", "arrow"):
            fs.move(f"{attempt}.{kind}", f"{root}/{name}.{kind}")
        yield pa.record_batch(
            {"file": [f"{folder}/{name}.arrow"], "part": pa.array([part], pa.int32()),
             "n_docs": [len(n_tokens)], "n_tokens": [int(n_tokens.sum())]}
        )

    ordered = (
        df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return df.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def open_sequences(file: str) -> pa.ipc.RecordBatchFileReader:
    """Rows of one file by batch number; mapped, not copied, where the file is local."""
    fs, path = filesystem(file)
    local = fs.type_name == "local"
    return pa.ipc.open_file(pa.memory_map(path) if local else fs.open_input_file(path))


def read_index(file: str) -> pa.Table:
    fs, path = filesystem(os.path.splitext(file)[0] + ".index")
    with fs.open_input_file(path) as source:
        return pa.ipc.open_file(source).read_all()


def document_ids(file: str) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
    """Each document of a file: id, first token in the file, its ids as slices of the file's buffers."""
    index, reader = read_index(file), open_sequences(file)
    number, begin, ids = -1, 0, np.zeros(0, np.uint16)
    for key, start, size in zip(*(index.column(c).to_pylist() for c in INDEX.names)):
        slices, at = [], start
        while at < start + size:
            while at >= begin + len(ids):
                number, begin = number + 1, begin + len(ids)
                rows = reader.get_batch(number).column("input_ids")
                ids = rows.flatten().to_numpy()
            stop = min(start + size, begin + len(ids))
            slices.append(ids[at - begin : stop - begin])
            at = stop
        yield key, start, slices


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: id, global start, number of ids, CRC-32 of its 32-bit ids."""
    # One row per file: the only thing that comes to the driver.
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("part").collect()
    starts = np.cumsum([0] + [f.n_tokens for f in files]).tolist()
    listed = spark.createDataFrame([(f.file, s) for f, s in zip(files, starts)], "file string, base bigint")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for key, start, slices in document_ids(file):
                    crc = 0
                    for part in slices:
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    rows.append((key, base + start, sum(map(len, slices)), crc))
                names = ("doc_id", "start", "n_tokens", "ids_crc32")
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    spread = listed.repartition(max(1, len(files)))
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
