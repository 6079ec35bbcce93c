"""Relational scans and sinks through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Rows per round trip; bounds the memory of one executor connection.
DEFAULTS = {"batchsize": "10000", "fetchsize": "10000"}


def scan_jdbc(spark: SparkSession, url: str, table: str, **options: object) -> DataFrame:
    """A table; Spark pushes filters and columns down.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read a
    large table in parallel.
    """
    return spark.read.format("jdbc").options(**DEFAULTS, url=url, dbtable=table, **options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: object) -> None:
    """Append, creating the table with the frame's schema when it is missing."""
    df.write.format("jdbc").options(**DEFAULTS, url=url, dbtable=table, **options).mode(mode).save()


def write_jdbc_all(tables: Mapping[str, DataFrame], url: str, **options: object) -> None:
    """Replace several tables."""
    for name, df in tables.items():
        write_jdbc(df, url, name, "overwrite", **options)
