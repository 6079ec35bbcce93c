"""Landing to trusted and trusted to exploitation, each file once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.operators.incremental import ledger_append, ledger_key, ledger_read, pending
from citylake.operators.joins import lookup
from citylake.sources.files import split_path

Transform = Callable[[DataFrame], DataFrame]


def _documents(
    spark: SparkSession, src: str, schema: T.StructType | str, fmt: str, multiline: bool
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if fmt == "json":
        reader = reader.option("multiLine", multiline)
    parts = split_path(F.col("_metadata.file_path"))
    return reader.load(src).withColumns(
        {"city": parts["city"], "file_name": parts["file_name"]}
    )


def sync_trusted(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    schema: T.StructType | str,
    transform: Transform = lambda df: df,
    fmt: str = "json",
    multiline: bool = True,
    partition_by: str | None = "city",
) -> None:
    """Process every landing file not seen before and add the rows to the trusted table.

    The checkpoint remembers the files, so a rerun adds nothing and a failed run is resumed.
    ``multiline`` reads one JSON document per file, else one per line.
    """
    rows = transform(_documents(spark, src, schema, fmt, multiline))
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.trigger(availableNow=True).start(dst).awaitTermination()


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the runs that share a checkpoint; a lost checkpoint starts a new one."""
    path = f"{checkpoint}/run_id"
    try:
        return spark.read.text(path).first().value
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return name


def sync_exploitation(
    spark: SparkSession,
    feed: str,
    src: str,
    dst: str,
    ledger: str,
    checkpoint: str,
    schema: T.StructType | str,
    transform: Transform = lambda df: df,
    fmt: str = "parquet",
    multiline: bool = True,
) -> None:
    """Append files whose key the ledger lacks, then log the keys.

    Data and ledger are written to one folder per batch with overwrite, so a replayed batch
    replaces its own output instead of adding to it. The folder is named by batch and run: batch
    numbers start again with a new checkpoint, and the run is kept inside the checkpoint.
    """
    files = _documents(spark, src, schema, fmt, multiline)
    run = _run_id(spark, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        here, name = batch.sparkSession, f"{run}-{batch_id}"
        # A replayed batch must not see its own entries.
        earlier = ledger_read(here, ledger).where(F.col("batch") != name)
        keyed = batch.withColumn(
            "file_key", ledger_key(F.lit(feed), F.col("city"), F.col("file_name"))
        )
        # One row per file meets the ledger, not one per record.
        new = pending(keyed.select("file_key").distinct(), earlier)
        rows = lookup(keyed, new.withColumnRenamed("file_key", "_new"), {"_new": F.col("file_key")}, "left_semi")
        transform(rows).write.mode("overwrite").parquet(f"{dst}/batch={name}")
        ledger_append(earlier, new).write.mode("overwrite").parquet(f"{ledger}/batch={name}")

    (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )

