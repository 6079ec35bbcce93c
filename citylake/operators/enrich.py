"""Joins that add or repair values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.functions.base import as_col, strip
from citylake.operators.dedupe import dedupe
from citylake.operators.joins import lookup
from citylake.operators.schema import named
from citylake.session import materialise


def translate(
    df: DataFrame,
    cols: Sequence[str],
    dictionary: DataFrame | None,
    source: str = "source",
    target: str = "target",
) -> DataFrame:
    """Replace values found in a (source, target) table; null, blank and unknown values stay.

    The dictionary is reduced to one row per source and pre-filtered, so the join never adds
    rows. It is written once, so Spark knows its size before it plans the joins: it broadcasts a
    dictionary below its size threshold without a shuffle of ``df``, whose few values would each
    go to one task, and otherwise shuffles, where a value that dominates the column is split.
    """
    if dictionary is None or not cols:
        return df
    entries = dedupe(
        dictionary.select(F.col(source).alias("_source"), F.col(target).alias("_target")).where(
            F.col("_source").isNotNull() & F.col("_target").isNotNull()
        ),
        ["_source"],
    )
    entries = materialise(entries, "dictionary")
    order = df.columns
    for name in cols:
        key = F.when(strip(named(name)) != "", named(name))
        df = (
            lookup(df, entries, {"_source": key}, "left")
            .withColumn(name, F.coalesce(F.col("_target"), named(name)))
            .drop("_source", "_target")
        )
    return df.select([named(c) for c in order])


def apply_addresses(
    accommodation: DataFrame,
    repairs: DataFrame,
    key: str = "hotel_id",
    address: str = "property_address",
    postcode: str = "property_postalcode",
    latest: Sequence[Column] = (),
) -> DataFrame:
    """Overwrite both address and postcode where a repair offers either; else keep both.

    Empty repairs are dropped and one repair per key is kept (the first under ``latest``)
    before the join.
    """
    useful = repairs.where(F.col(address).isNotNull() | F.col(postcode).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(address).alias("_address"),
        F.col(postcode).alias("_postcode"),
        *[c.alias(f"_order{i}") for i, c in enumerate(latest)],
    )
    order = [F.col(f"_order{i}").desc_nulls_last() for i in range(len(latest))]
    one = dedupe(useful, ["_key"], [*order, "_address", "_postcode"])
    repaired = F.col("_key").isNotNull()
    return (
        lookup(accommodation, one, {"_key": F.col(key)}, "left")
        .withColumns(
            {
                address: F.when(repaired, F.col("_address")).otherwise(F.col(address)),
                postcode: F.when(repaired, F.col("_postcode")).otherwise(F.col(postcode)),
            }
        )
        .select([named(c) for c in accommodation.columns])
    )


def photo_pairs(
    hotels: DataFrame, key: str, urls: Column | str, hashes: Column | str | None = None
) -> DataFrame:
    """Rows (key, position, hash, url) pairing a hotel's hashes with its URLs by position.

    Without given hashes they are computed; given ones pair up to the shorter list.
    """
    urls = as_col(urls)
    if hashes is None:
        return hotels.select(named(key), F.posexplode(urls).alias("position", "url")).select(
            named(key), "position", F.sha2("url", 256).alias("hash"), "url"
        )
    hashes = as_col(hashes)
    shortest = F.least(F.size(urls), F.size(hashes))
    pairs = F.slice(F.arrays_zip(hashes.alias("hash"), urls.alias("url")), F.lit(1), shortest)
    return hotels.select(named(key), F.posexplode(pairs).alias("position", "_pair")).select(
        named(key), "position", "_pair.hash", "_pair.url"
    )
