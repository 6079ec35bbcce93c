"""Session settings, table access and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are designed for. All are safe to set on a
# running session. Only the time zone can change results: of expressions on zoned timestamps.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Geometry and text cost far more time per byte than the 1 MB default assumes; small
    # partitions keep all cores busy. Large inputs are not affected.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # A query's shuffle files go when it ends; frames that are used again were written.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build(master: str | None = None, app: str = "citylake", **conf: object) -> SparkSession:
    """Session for local runs and tests; on a cluster pass the existing one to ``tune``."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach, named by ``spark.checkpoint.dir``.

    What is written below it belongs to the caller, who sets its lifetime.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by writing ``df`` once to the shared folder and reading it back."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
