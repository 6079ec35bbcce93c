"""Postal polygons and accommodations to the postal graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions.postal import city_of_postcode
from citylake.operators import graph as N
from citylake.operators.dedupe import code_table
from citylake.operators.filters import in_list_or
from citylake.operators.geo import adjacency
from citylake.operators.schema import union_all


def spanish_cities(polygons: DataFrame, cities: list[str], code: str = "COD_POSTAL") -> DataFrame:
    return polygons.withColumn("city", city_of_postcode(code)).where(F.col("city").isin(cities))


def paris_polygons(
    polygons: DataFrame, postcodes: DataFrame, code: str = "ID", label: str = "LIB"
) -> DataFrame:
    """Polygons whose code is in use by accommodations or that are labelled Paris."""
    return in_list_or(polygons, code, postcodes, "property_postalcode", F.col(label) == "Paris")


def postal_graph(
    polygons: dict[str, DataFrame], accommodation: DataFrame, code: str = "COD_POSTAL"
) -> dict[str, DataFrame]:
    """Node and edge tables; ``polygons`` maps a city to its (code, ring) rows."""
    zips = union_all([N.zip_nodes(code_table(p, code), city) for city, p in polygons.items()])
    feed = N.graph_feed(accommodation)
    hotels = N.accommodation_nodes(feed)
    routes = union_all(
        [N.route_edges(adjacency(p, code), zips, f"{code}_1", f"{code}_2") for p in polygons.values()]
    )
    placed = feed.select("property_id", "property_postalcode").distinct()
    return {
        "zip_nodes": zips,
        "accommodation_nodes": hotels,
        "route_edges": routes,
        "located_in_edges": N.located_in(placed, hotels, zips),
    }
