"""Graph tables over the provided tables: nations as postcodes, customers as accommodations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query
from citylake.operators import graph as N
from citylake.session import scratch, table



def _zips(spark: SparkSession, folder: str) -> DataFrame:
    codes = table(spark, folder, "nation").select(F.col("n_nationkey").alias("POSTAL_CODE"))
    twice = table(spark, folder, "region").select(F.col("r_regionkey").alias("POSTAL_CODE"))
    return N.zip_nodes(codes, "Madrid").unionByName(N.zip_nodes(twice, "Barcelona"))


ZIP_SQL = """
    zips AS (SELECT n_nationkey::VARCHAR AS z, 'Madrid' AS city FROM nation
             UNION ALL SELECT r_regionkey::VARCHAR, 'Barcelona' FROM region)
"""


@query(f"WITH {ZIP_SQL} SELECT z AS \"ZIPCODE\", city AS \"CITY\" FROM zips")
def zip_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return _zips(spark, folder)


@query(
    f"""
    WITH {ZIP_SQL}
    SELECT s.a AS "SRC", s.b AS "DST", s.d AS "Distance" FROM
      (SELECT l_orderkey, l_linenumber, (l_partkey % 30)::VARCHAR AS a, (l_suppkey % 27)::VARCHAR AS b,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS d FROM lineitem) s
      JOIN zips z1 ON s.a = z1.z JOIN zips z2 ON s.b = z2.z
    """
)
def route_edges(spark: SparkSession, folder: str) -> DataFrame:
    distance = F.when(F.col("l_returnflag") == "R", "x").otherwise(F.col("l_extendedprice").cast("string"))
    distances = table(spark, folder, "lineitem").select(
        (F.col("l_partkey") % 30).alias("COD_POSTAL_1"), (F.col("l_suppkey") % 27).alias("COD_POSTAL_2"),
        distance.alias("distance"),
    )
    return N.route_edges(distances, _zips(spark, folder))


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("property_id"),
        F.col("c_acctbal").alias("property_latitude"),
        F.lit(2.5).alias("property_longitude"),
        F.col("c_name").alias("property_name"),
        F.col("c_mktsegment").alias("city_code_name"),
        F.col("c_nationkey").cast("string").alias("property_postalcode"),
    )


@query(
    """
    SELECT c_custkey::VARCHAR AS "ID", c_name AS "NAME", '2.5' AS "X_POS", c_acctbal::VARCHAR AS "Y_POS",
      c_mktsegment AS "CITY" FROM customer
    """
)
def accommodation_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return N.accommodation_nodes(_feed(spark, folder))


@query(
    f"""
    WITH {ZIP_SQL}
    SELECT c_custkey::VARCHAR AS "ID", z AS "ZIPCODE" FROM customer JOIN zips ON c_nationkey::VARCHAR = z
    """
)
def located_in(spark: SparkSession, folder: str) -> DataFrame:
    feed = _feed(spark, folder)
    return N.located_in(feed, N.accommodation_nodes(feed), _zips(spark, folder))


@query(
    """
    SELECT DISTINCT l_suppkey AS property_id, l_tax AS property_latitude, l_discount AS property_longitude,
      l_returnflag AS property_name, l_linestatus AS city_code_name,
      lpad((l_partkey % 100)::VARCHAR, 5, '0') AS property_postalcode FROM lineitem
    """
)
def graph_feed(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("property_id"), F.col("l_tax").alias("property_latitude"),
        F.col("l_discount").alias("property_longitude"), F.col("l_returnflag").alias("property_name"),
        F.col("l_linestatus").alias("city_code_name"),
        (F.col("l_partkey") % 100).cast("string").alias("property_postalcode"),
        "l_orderkey",
    )
    return N.graph_feed(rows)


@query(
    f"""
    WITH {ZIP_SQL}
    SELECT 'zip_nodes' AS name, z AS a, city AS b FROM zips
    UNION ALL SELECT 'accommodation_nodes', c_custkey::VARCHAR, c_name FROM customer
    UNION ALL SELECT 'located_in_edges', c_custkey::VARCHAR, z FROM customer JOIN zips ON c_nationkey::VARCHAR = z
    """
)
def graph_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """A graph of other rows is built first and replaced as a whole; then all tables are read back."""
    path = scratch(spark, "graph")
    feed, zips = _feed(spark, folder), _zips(spark, folder)
    for rows in (feed.where("property_id % 2 = 0").unionByName(feed), feed):
        hotels = N.accommodation_nodes(rows)
        N.build_graph({"located_in_edges": N.located_in(rows, hotels, zips), "zip_nodes": zips, "accommodation_nodes": hotels}, path)
    keys = {"zip_nodes": ("ZIPCODE", "CITY"), "accommodation_nodes": ("ID", "NAME"), "located_in_edges": ("ID", "ZIPCODE")}
    frames = [
        spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("name"), F.col(a).alias("a"), F.col(b).alias("b"))
        for name, (a, b) in keys.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
