"""Deduplication, latest row per key, distinct values and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.operators.schema import named


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    The rank filter lets Spark keep one row per key in every map task before the shuffle
    (``WindowGroupLimit``), so a key that holds most rows still reaches its reducer as one row
    per map task.
    """
    w = Window.partitionBy(*[named(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], order_col: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    order = [named(c).desc_nulls_last() for c in (order_col, *tie_break)]
    return first_per_key(df, keys, order)


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    null_keys: str = "collapse",
) -> DataFrame:
    """One row per key; the least row under ``order_by`` (default: all other columns) stays.

    ``null_keys="collapse"`` treats nulls as equal. ``"keep"`` keeps every row with a null key.
    """
    if order_by is None:
        order_by = [c for c, t in df.dtypes if c not in keys and not t.startswith("map")]
    order = [named(c).asc() if isinstance(c, str) else c for c in order_by]
    order = order or [named(keys[0]).asc()]
    if null_keys == "collapse":
        return first_per_key(df, keys, order)
    complete = F.lit(True)
    for k in keys:
        complete = complete & named(k).isNotNull()
    return first_per_key(df.where(complete), keys, order).unionByName(df.where(~complete))


def distinct_postcodes(
    df: DataFrame, city: str = "city_code_name", postcode: str = "property_postalcode"
) -> DataFrame:
    return df.where(named(postcode).isNotNull()).select(named(city), named(postcode)).distinct()


def code_table(df: DataFrame, name: str, alias: str = "POSTAL_CODE") -> DataFrame:
    return df.select(named(name).alias(alias)).distinct()


def postcodes_by_city(
    df: DataFrame, city: str = "city_code_name", postcode: str = "property_postalcode"
) -> DataFrame:
    """The complete ordered list of each city's distinct postcodes, as rows (city, position, postcode).

    Duplicates go first (partial aggregation). Positions come from ranks within the two first
    characters plus the number of codes before them, so no task sorts a whole city.
    """
    pairs = distinct_postcodes(df, city, postcode).withColumn(
        "_head", F.substring(named(postcode).cast("string"), 1, 2)
    )
    order = named(postcode).cast("string")
    local = F.row_number().over(Window.partitionBy(named(city), "_head").orderBy(order))
    sizes = pairs.groupBy(named(city).alias("_city"), F.col("_head").alias("_area")).count()
    before = F.sum("count").over(Window.partitionBy("_city").orderBy("_area")) - F.col("count")
    bases = sizes.select("_city", "_area", before.alias("_base"))
    same = named(city).eqNullSafe(F.col("_city")) & (F.col("_head") == F.col("_area"))
    ranked = pairs.withColumn("_local", local).join(bases, same)
    position = (F.col("_base") + F.col("_local")).cast("bigint").alias("position")
    return ranked.select(named(city), position, named(postcode))


def profile(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Row count, and non-null count per column, in one pass."""
    names = list(names) if names is not None else df.columns
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(named(n)).alias(f"{n}_present") for n in names]
    )
