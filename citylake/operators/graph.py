"""Postal graph as four tables: two of nodes, two of edges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.numeric import to_numeric
from citylake.functions.postal import pad_zip
from citylake.operators.joins import lookup

FEED_COLUMNS = [
    "property_id", "property_latitude", "property_longitude", "property_name", "city_code_name",
    "property_postalcode",
]


def zip_nodes(codes: DataFrame, city: str, code: str = "POSTAL_CODE") -> DataFrame:
    return codes.select(F.col(code).cast("string").alias("ZIPCODE"), F.lit(city).alias("CITY"))


def accommodation_nodes(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col("property_id").cast("string").alias("ID"),
        F.col("property_name").cast("string").alias("NAME"),
        F.col("property_longitude").cast("string").alias("X_POS"),
        F.col("property_latitude").cast("string").alias("Y_POS"),
        F.col("city_code_name").cast("string").alias("CITY"),
    )


def _counted(nodes: DataFrame, key: str) -> DataFrame:
    """Key with its number of nodes; edges only need how often each end matches."""
    return nodes.groupBy(F.col(key).alias("_node")).agg(F.count(F.lit(1)).alias("_times"))


def _times_matched(rows: DataFrame, nodes: DataFrame, key: str, node_key: str) -> DataFrame:
    """Inner join that repeats a row once per matching node, with one join row per key.

    Duplicate nodes are counted before the shuffle, so a key shared by many of them adds no
    rows to the join; the repeats are made row by row afterwards.
    """
    return (
        lookup(rows, _counted(nodes, node_key), {"_node": F.col(key)}, "inner")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
        .drop("_node", "_times", "_copy")
    )


def route_edges(
    distances: DataFrame,
    zips: DataFrame,
    first: str = "COD_POSTAL_1",
    second: str = "COD_POSTAL_2",
    distance: str = "distance",
) -> DataFrame:
    """One edge per distance row and matching pair of nodes; unmatched rows vanish.

    An unreadable distance is null.
    """
    rows = distances.select(
        F.col(first).cast("string").alias("SRC"),
        F.col(second).cast("string").alias("DST"),
        to_numeric(distance).alias("Distance"),
    )
    return _times_matched(_times_matched(rows, zips, "SRC", "ZIPCODE"), zips, "DST", "ZIPCODE")


def located_in(
    placed: DataFrame,
    accommodations: DataFrame,
    zips: DataFrame,
    key: str = "property_id",
    postcode: str = "property_postalcode",
) -> DataFrame:
    """One edge per placement row and matching (accommodation node, postcode node)."""
    rows = placed.select(
        F.col(key).cast("string").alias("ID"), F.col(postcode).cast("string").alias("ZIPCODE")
    )
    return _times_matched(_times_matched(rows, accommodations, "ID", "ID"), zips, "ZIPCODE", "ZIPCODE")


def graph_feed(accommodation: DataFrame) -> DataFrame:
    """The six graph columns, distinct rows, postcode padded."""
    feed = accommodation.select(*FEED_COLUMNS).dropDuplicates()
    return feed.withColumn("property_postalcode", pad_zip("property_postalcode"))


def build_graph(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Replace the graph: node tables first, then edge tables."""
    nodes = [n for n in tables if n.endswith("_nodes")]
    for name in [*nodes, *[n for n in tables if n not in nodes]]:
        tables[name].write.mode("overwrite").parquet(f"{folder}/{name}")
