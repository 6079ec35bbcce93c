"""Row filters and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.functions.base import as_col
from citylake.functions.text import any_keyword
from citylake.operators.joins import lookup

POSITION_FLAG = "position available"

# Keywords per category label.
CATEGORY_KEYWORDS: dict[str, list[str]] = {
    "SPORT": ["sport", "football", "soccer", "tennis", "basketball", "gym", "swimming"],
    "NATURE": ["park", "garden", "nature", "forest", "mountain", "river", "lake"],
    "CULTURE": [
        "museum", "theatre", "theater", "art", "history", "exhibition", "gallery", "library",
        "concert", "cultural",
    ],
    "SOCIAL_LIFE": [
        "bar", "pub", "club", "nightlife", "restaurant", "social", "event", "party", "festival",
    ],
}


def is_known(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNotNull() & ~F.isnan(c)


def with_position_flag(
    df: DataFrame, lat: Column | str, lon: Column | str, name: str = POSITION_FLAG
) -> DataFrame:
    """``yes`` when both coordinates are known, ``no`` when one is null or NaN."""
    return df.withColumn(name, F.when(is_known(lat) & is_known(lon), "yes").otherwise("no"))


def has_position(df: DataFrame, lat: Column | str, lon: Column | str) -> DataFrame:
    return df.where(is_known(lat) & is_known(lon))


def needs_address(
    df: DataFrame, address: str = "property_address", postcode: str = "property_postalcode"
) -> DataFrame:
    return df.where(F.col(address).isNull() | F.col(postcode).isNull())


def present(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull())


def in_list_or(df: DataFrame, key: str, ids: DataFrame, id_col: str, predicate: Column) -> DataFrame:
    """Rows whose key is in ``ids`` or that meet ``predicate``, each once.

    Rows that meet the predicate never enter the join; the rest is a left-semi join.
    """
    sure = F.coalesce(predicate, F.lit(False))
    keys = ids.select(F.col(id_col).alias("_id")).distinct()
    rest = lookup(df.where(~sure), keys, {"_id": F.col(key)}, "left_semi").select(df.columns)
    return df.where(sure).unionByName(rest)


def drop_incomplete(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(names) if names else None)


def query_events(df: DataFrame, predicate: str = "") -> DataFrame:
    """Rows that meet a SQL predicate; an empty predicate keeps all rows."""
    return df.where(predicate) if predicate else df


def with_categories(
    df: DataFrame,
    name: str = "name",
    description: str = "description",
    keywords: Mapping[str, Sequence[str]] = CATEGORY_KEYWORDS,
) -> DataFrame:
    """One 0/1 column per label: any keyword is a substring of the lower-cased text."""
    # A generated column is computed once, whatever the number of its uses.
    text = F.lower(F.concat_ws(" ", F.col(name), F.col(description)))
    labelled = df.withColumn("_text", F.explode(F.array(text)))
    flags = {
        label: F.when(any_keyword(F.col("_text"), words), 1).otherwise(0)
        for label, words in keywords.items()
    }
    return labelled.withColumns(flags).drop("_text")
