"""Bounded samples of labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_texts(df: DataFrame, limit: int, text: str = "text") -> DataFrame:
    """``df`` with ``h``, cut to the ``limit`` different texts with the least hashes; copies stay.

    Only hashes are sorted, never texts.
    """
    hashed = df.withColumn("h", F.xxhash64(text))
    least = hashed.select("h").distinct().orderBy("h").limit(limit)
    last = least.agg(F.max("h")).first()[0]
    return hashed.where(F.col("h") <= F.lit(last)) if last is not None else hashed.where("false")
