"""File scans and sinks of the lake zones."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions.text import clean_line, decode_text
from citylake.operators.dedupe import dedupe
from citylake.operators.incremental import missing_vectors
from citylake.operators.schema import named, tag, union_all
from citylake.session import scratch

DELIMITERS = [";", ",", "|", "\t"]  # fixed values: separators that are recognised
SURPLUS = "_surplus"
FETCH_BYTES = 32 * 1024 * 1024  # contents held by a task before they are passed on


def sniff_delimiter(header: str) -> str:
    """The most frequent known delimiter outside quotes; a comma when there is none."""
    plain = "".join(header.split('"')[::2])
    best = max(DELIMITERS, key=plain.count)
    return best if best in plain else ","


def headers(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> dict[str, list[str]]:
    """First line of every file that has one, with the files that begin with it.

    Only the first block of each file is read.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"),
    )
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("value"))
    text = F.regexp_replace(F.decode(F.col("value").cast("binary"), encoding), "^\ufeff", "")
    found = first.groupBy(text.alias("header")).agg(F.collect_list("file").alias("files"))
    return {r.header: r.files for r in found.collect()}


def scan_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str = "UTF-8",
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Delimited files with a header.

    Files are read by their own header, so columns may come in any order and some may be absent.
    The delimiter is taken from the header unless given. Without a schema every column is text.
    Rows with more fields than the header are skipped; missing fields are null. ``multiline`` is
    for values that contain line breaks; it makes every file one task.
    """
    frames = []
    for header, files in sorted(headers(spark, path, encoding).items()):
        own_sep = sep or sniff_delimiter(header)
        names = [n.strip().strip('"') for n in _split_header(header, own_sep)]
        declared = {f.name: f for f in schema.fields} if schema is not None else {}
        fields = [declared.get(n, T.StructField(n, T.StringType())) for n in names]
        if schema is not None and not set(names) & set(declared):
            fields = schema.fields  # a header of other names: by position
        # One field more than declared: it is filled only by rows that are too long.
        wide = T.StructType([*fields, T.StructField(SURPLUS, T.StringType())])
        rows = (
            spark.read.schema(wide)
            .options(
                header=True, sep=own_sep, encoding=encoding, mode="PERMISSIVE", multiLine=multiline,
                quote='"', escape='"',
            )
            .csv(files)
        )
        frames.append(rows.where(F.col(SURPLUS).isNull()).drop(SURPLUS))
    if not frames:
        return spark.createDataFrame([], schema or T.StructType([]))
    out = union_all(frames)
    return out.select([named(f.name) for f in schema.fields if f.name in out.columns]) if schema is not None else out


def _split_header(header: str, sep: str) -> list[str]:
    import csv

    return next(csv.reader([header], delimiter=sep), [])


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True) -> DataFrame:
    """Landing documents under a declared schema, all files in one job."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def scan_text_repaired(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as text, decoded as UTF-8 or else ISO-8859-1."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", decode_text("content").alias("text"))


def scan_clean_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ISO-8859-1 files without quotes and with the known entities replaced."""
    # The text source keeps the bytes and every line, blank ones too.
    lines = spark.read.text(path).select(F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"))
    return lines.select(clean_line("line").alias("line"))


def encodings(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by encoding: UTF-8 when every line is valid, else ISO-8859-1."""
    lines = spark.read.text(path).select(
        F.is_valid_utf8("value").alias("valid"), F.col("_metadata.file_path").alias("file")
    )
    files = lines.groupBy("file").agg(F.when(F.bool_and("valid"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"))
    # Names only: one row per file, as for the headers.
    found = files.groupBy("encoding").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return {r.encoding: r.files for r in found.collect()}


def scan_sources(
    spark: SparkSession, sources: Mapping[str, str], encoding: str | None = None, multiline: bool = False
) -> dict[str, DataFrame]:
    """One tagged frame per city; a source that is missing or empty gives an empty frame.

    The empty frame has the columns of the first good source. Unless given, each file's encoding
    is found by reading it, so a folder may hold files of both encodings.
    """
    frames: dict[str, DataFrame | None] = {}
    for city, path in sources.items():
        try:
            known = {encoding: path} if encoding else encodings(spark, path)
            parts = [scan_csv(spark, of, encoding=name, multiline=multiline) for name, of in sorted(known.items())]
            rows = union_all([p for p in parts if p.columns]) if any(p.columns for p in parts) else None
            frames[city] = tag(rows, "city", city) if rows is not None else None
        except AnalysisException:
            frames[city] = None
    good = [f for f in frames.values() if f is not None]
    fallback = good[0].schema if good else T.StructType([T.StructField("city", T.StringType())])
    return {
        city: frame if frame is not None else spark.createDataFrame([], fallback)
        for city, frame in frames.items()
    }


def _staged(df: DataFrame, path: str, partition_by: str | None = None) -> bool:
    """Write ``df`` once beside ``path``; whether it has rows. An empty result is dropped again.

    The plan runs once: whether there are rows is seen on what was written.
    """
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if df.sparkSession.read.schema(df.schema).parquet(path).isEmpty():
        _filesystem(df.sparkSession, path).delete(_path(df.sparkSession, path), True)
        return False
    return True


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in the place of another: two moves of names, no data."""
    fs, old = _filesystem(spark, path), f"{path}-old-{uuid.uuid4().hex}"
    kept = fs.exists(_path(spark, path)) and fs.rename(_path(spark, path), _path(spark, old))
    if not fs.rename(_path(spark, staged), _path(spark, path)):
        raise OSError(f"could not move {staged} to {path}")
    if kept:
        fs.delete(_path(spark, old), True)


def write_trusted(df: DataFrame, path: str, partition_by: str | None = None) -> bool:
    """Replace a trusted Parquet table; an empty frame leaves it alone. ``df`` may read the old table."""
    staged = f"{path.rstrip('/')}-new-{uuid.uuid4().hex}"
    if not _staged(df, staged, partition_by):
        return False
    _swap(df.sparkSession, staged, path.rstrip("/"))
    return True


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_if_nonempty(df: DataFrame, table: str | None = None, path: str | None = None) -> bool:
    """Replace a result table, by name or path; an empty result keeps the old one."""
    if path is not None:
        return write_trusted(df, path)
    spark = df.sparkSession
    staged = scratch(spark, "result")
    if not _staged(df, staged):
        return False
    spark.read.schema(df.schema).parquet(staged).write.mode("overwrite").saveAsTable(table)
    _filesystem(spark, staged).delete(_path(spark, staged), True)
    return True


def split_path(path: Column) -> dict[str, Column]:
    """Last three parts of a lake path."""
    parts = F.split(path, "/")
    return {
        "data_type": F.try_element_at(parts, F.lit(-3)),
        "city": F.try_element_at(parts, F.lit(-2)),
        "file_name": F.try_element_at(parts, F.lit(-1)),
    }


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def list_zone(spark: SparkSession, root: str, data_type: str | None = None) -> DataFrame:
    """Files below a zone as (path, data_type, city, file_name); contents are not read."""
    paths = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    )
    files = paths.withColumns(split_path(F.col("path")))
    return files.where(F.col("data_type") == data_type) if data_type else files


def _opened(path: str):
    """File system and plain path of a lake path, as the listing writes it (unescaped)."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    authority, _, name = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{base.rstrip('/')}/{name}"


def fetch_contents(paths: DataFrame, path: str = "path", out: str = "content") -> DataFrame:
    """``paths`` with the bytes of each named file, opened one by one in the tasks; null for a null path."""
    names = paths.columns
    schema = T.StructType([*paths.schema.fields, T.StructField(out, T.BinaryType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            held, size, begin = [], 0, 0
            for n, name in enumerate(batch.column(names.index(path)).to_pylist()):
                if name is None:
                    held.append(None)
                else:
                    system, plain = _opened(name)
                    with system.open_input_file(plain) as file:
                        held.append(file.read())
                    size += len(held[-1])
                if size >= FETCH_BYTES or n + 1 == batch.num_rows:
                    columns = [c.slice(begin, len(held)) for c in batch.columns]
                    yield pa.record_batch([*columns, pa.array(held, pa.binary())], names=[*names, out])
                    held, size, begin = [], 0, n + 1

    return paths.mapInArrow(run, schema)


def write_contents(df: DataFrame, root: str, name: str = "name", content: str = "content") -> DataFrame:
    """One file below ``root`` per row; the rows written, as (path, length). A task that runs again writes the same."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            written = []
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, plain = _opened(f"{root}/{file}")
                system.create_dir(plain.rpartition("/")[0], recursive=True)
                with system.open_output_stream(plain) as stream:
                    stream.write(data or b"")
                written.append((f"{root}/{file}", len(data or b"")))
            columns = zip(*written) if written else ([], [])
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()))], names=["path", "length"])

    return df.select(name, content).mapInArrow(run, "path string, length bigint")


def assets_table(spark: SparkSession, path: str, stored: DataFrame | None = None) -> DataFrame:
    """Binary files as (id = file stem, image_bytes), added to ``stored`` where absent.

    Winners (the least path of an id) are chosen on names alone; then contents are opened for them only.
    Files without a byte are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    winners = dedupe(files.select(file_stem(F.col("path")).alias("id"), "path"), ["id"], ["path"])
    if stored is not None:
        winners = missing_vectors(winners, stored)
    added = fetch_contents(winners.select("id", "path"), out="image_bytes").select("id", "image_bytes")
    return added if stored is None else stored.unionByName(added)
