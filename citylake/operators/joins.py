"""Join to a reduced side that stays splittable under skew."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, on: Mapping[str, Column], how: str) -> DataFrame:
    """Join ``left`` to ``right``, which holds one row per key; ``on`` maps right names to left keys.

    Spark broadcasts the right side when it is below its size threshold. Otherwise AQE cuts a hot
    key of the left side into several tasks, but only when both sides come straight out of a
    shuffle made for the join. A right side that was grouped by the same key would be used as it
    lies, and the hot key would stay in one task. A hash of the key as one more join column makes
    Spark shuffle the reduced side for the join. The right key columns are dropped from the result
    of an inner or outer join by the caller.
    """
    names = list(on)
    typed_left, typed_right = [], []
    for name in names:
        wanted = _common_type(left, on[name], right, name)
        typed_left.append(_hashable(on[name].cast(wanted), wanted))
        typed_right.append(_hashable(F.col(name).cast(wanted), wanted))
    left = left.withColumn("_left_hash", F.xxhash64(*typed_left))
    right = right.withColumn("_right_hash", F.xxhash64(*typed_right))
    condition = F.col("_left_hash") == F.col("_right_hash")
    for name in names:
        condition = condition & (on[name] == F.col(name))
    return left.join(right, condition, how).drop("_left_hash", "_right_hash")


def _common_type(left: DataFrame, key: Column, right: DataFrame, name: str):
    mine, theirs = left.select(key.alias("k")).schema["k"].dataType, right.schema[name].dataType
    if mine == theirs:
        return mine
    both = F.coalesce(F.lit(None).cast(mine), F.lit(None).cast(theirs)).alias("k")
    return left.select(both).schema["k"].dataType


def _hashable(key: Column, dtype) -> Column:
    """Zero and minus zero are equal as keys and must hash alike."""
    return key + F.lit(0.0).cast(dtype) if dtype.simpleString() in ("double", "float") else key
