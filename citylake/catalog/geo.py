"""Geometry over squares, shapes of several parts and points derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query
from citylake.functions import geometry as G
from citylake.functions import shapes as S
from citylake.operators import geo, shapes
from citylake.session import table


def _square(x: Column, y: Column, width: float = 1.0, height: float = 1.0) -> Column:
    x, y = x.cast("double"), y.cast("double")
    return G.ring_of([(x, y), (x + width, y), (x + width, y + height), (x, y + height), (x, y)])


def _squares(spark: SparkSession, folder: str) -> DataFrame:
    """Unit squares, 40 to a row, one per part."""
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(
        k.cast("string").alias("COD_POSTAL"),
        _square(k % 40, F.floor(k / 40)).alias("ring"),
    )


SQUARES = "WITH s AS (SELECT p_partkey AS k, p_partkey % 40 AS x, p_partkey // 40 AS y FROM part)"
NEIGHBOURS = "FROM s a JOIN s b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND a.k <> b.k"


@query(f'{SQUARES} SELECT a.k::VARCHAR AS "COD_POSTAL_1", b.k::VARCHAR AS "COD_POSTAL_2" {NEIGHBOURS}')
def touching_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return geo.touching_pairs(_squares(spark, folder))


@query(
    f"""
    {SQUARES}
    SELECT a.k::VARCHAR AS "COD_POSTAL_1", b.k::VARCHAR AS "COD_POSTAL_2",
      round(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)), 9) AS distance {NEIGHBOURS}
    """
)
def grid_adjacency(spark: SparkSession, folder: str) -> DataFrame:
    pairs = geo.adjacency(_squares(spark, folder))
    return pairs.withColumn("distance", F.round("distance", 9))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 40 + l_quantity / 2 AS x,
      l_suppkey + 0.5::DOUBLE AS y FROM lineitem
    """
)
def centroids(spark: SparkSession, folder: str) -> DataFrame:
    x, y, w = F.col("l_partkey") % 40, F.col("l_suppkey"), F.col("l_quantity")
    ring = G.ring_of([(x, y), (x + w, y), (x + w, y + 1), (x, y + 1), (x, y)])
    rows = table(spark, folder, "lineitem").withColumn("c", G.centroid(ring))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("c.x", 6).alias("x"),
        F.round("c.y", 6).alias("y"),
    )


@query(
    """
    SELECT o_orderkey, round(sqrt(power(o_custkey - o_orderkey, 2) + power(o_totalprice, 2)) * 111, 3) AS km
    FROM orders
    """
)
def km_points(spark: SparkSession, folder: str) -> DataFrame:
    km = G.km_points("o_custkey", F.lit(0.0), "o_orderkey", "o_totalprice")
    return table(spark, folder, "orders").select("o_orderkey", F.round(km, 3).alias("km"))


@query(
    """
    SELECT o_orderkey, round(111 * sqrt(power(greatest(abs(a - b) - 1, 0), 2)
      + power(greatest(abs(c - d) - 1, 0), 2)), 6) AS km
    FROM (SELECT o_orderkey, o_orderkey % 17 AS a, o_custkey % 13 AS b, o_orderkey % 5 AS c,
            o_custkey % 7 AS d FROM orders)
    """
)
def km_polygons(spark: SparkSession, folder: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    a, b = (S.shape_of_ring(_square(x, y)).alias(n) for n, x, y in (("a", o % 17, o % 5), ("b", c % 13, c % 7)))
    measured = shapes.with_boundary_distance(table(spark, folder, "orders").select("o_orderkey", a, b), "a", "b")
    return measured.select("o_orderkey", F.round(F.col("distance") * G.KM_PER_DEGREE, 6).alias("km"))


@query(
    """
    SELECT o_orderkey, round(111 * CASE
        WHEN x BETWEEN a AND a + 4 AND y BETWEEN c AND c + 4 THEN least(x - a, a + 4 - x, y - c, c + 4 - y)
        ELSE sqrt(power(greatest(a - x, 0, x - a - 4), 2) + power(greatest(c - y, 0, y - c - 4), 2)) END, 6) AS km
    FROM (SELECT o_orderkey, (o_orderkey % 17 / 2.0)::DOUBLE AS x, (o_custkey % 13 / 4.0)::DOUBLE AS y,
            o_orderkey % 5 AS a, o_custkey % 3 AS c FROM orders)
    """
)
def km_point_polygon(spark: SparkSession, folder: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    km = G.km_point_polygon(o % 17 / 2.0, c % 13 / 4.0, _square(o % 5, c % 3, 4.0, 4.0))
    return table(spark, folder, "orders").select("o_orderkey", F.round(km, 6).alias("km"))


@query(
    """
    WITH h AS (SELECT c_custkey, CASE WHEN c_custkey % 11 > 0 THEN (c_custkey * 7919 % 997) / 100.0::DOUBLE END AS lon,
                 (c_custkey * 104729 % 991) / 100.0::DOUBLE AS lat FROM customer),
         p AS (SELECT p_name AS address, p_brand AS postcode,
                 CASE WHEN p_partkey % 3 = 0 THEN 5 + (p_partkey * 31 % 997) / 100000.0::DOUBLE
                      ELSE (p_partkey * 13 % 83) / 10.0::DOUBLE END AS lon,
                 CASE WHEN p_partkey % 3 = 0 THEN 5 + (p_partkey * 17 % 991) / 100000.0::DOUBLE
                      ELSE (p_partkey * 29 % 79) / 10.0::DOUBLE END AS lat FROM part),
         n AS (SELECT c_custkey, min({'g': sqrt((p.lon - h.lon) * (p.lon - h.lon) + (p.lat - h.lat) * (p.lat - h.lat)),
                 'a': address, 'z': postcode}) AS m
               FROM h JOIN p ON sqrt((p.lon - h.lon) * (p.lon - h.lon) + (p.lat - h.lat) * (p.lat - h.lat)) <= 1.5
               GROUP BY c_custkey)
    SELECT h.c_custkey, m.a AS property_address, m.z AS property_postalcode
    FROM h LEFT JOIN n ON h.c_custkey = n.c_custkey
    """
)
def reverse_geocode(spark: SparkSession, folder: str) -> DataFrame:
    k, p = F.col("c_custkey"), F.col("p_partkey")
    hotels = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(k % 11 > 0, k * 7919 % 997 / 100.0).alias("property_longitude"),
        (k * 104729 % 991 / 100.0).alias("property_latitude"),
    )
    clustered = p % 3 == 0
    places = table(spark, folder, "part").select(
        F.col("p_name").alias("address"), F.col("p_brand").alias("postcode"),
        F.when(clustered, p * 31 % 997 / 100000.0 + 5).otherwise(p * 13 % 83 / 10.0).alias("longitude"),
        F.when(clustered, p * 17 % 991 / 100000.0 + 5).otherwise(p * 29 % 79 / 10.0).alias("latitude"),
    )
    found = geo.reverse_geocode(hotels, places, reach=1.5)
    return found.select("c_custkey", "property_address", "property_postalcode")


def _shape(k: Column, x: Column, y: Column) -> Column:
    """Cells four wide: 0 a frame with a hole in its middle, 1 an island in the frame to its left, 2 two parts, 3 a block."""
    square = lambda dx, dy, w, h: _square(x * 4 + dx, y * 4 + dy, float(w), float(h))
    frame = F.array(F.array(square(0, 0, 4, 4), F.reverse(square(1, 1, 2, 2))))
    island = F.array(F.array(square(-3, 1, 2, 2)))
    parts = F.array(F.array(square(0, 0, 1, 4)), F.array(square(2, 0, 2, 1)))
    block = F.array(F.array(square(0, 0, 4, 4)))
    return F.when(k == 0, frame).when(k == 1, island).when(k == 2, parts).otherwise(block)


def _shapes(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(k.alias("COD_POSTAL"), _shape(k % 4, k % 40, F.floor(k / 40)).alias("shape"))


#: The same as rectangles (u, v) to (u2, v2), their parts and holes; ``c`` has the centroids.
SHAPES = """
    s AS (SELECT p_partkey AS k, p_partkey % 4 AS kind, 4 * (p_partkey % 40) AS x, 4 * (p_partkey // 40) AS y FROM part),
    r AS (SELECT k, kind, false AS hole, x + CASE kind WHEN 1 THEN -3 ELSE 0 END AS u, y + CASE kind WHEN 1 THEN 1 ELSE 0 END AS v,
            x + CASE kind WHEN 1 THEN -1 WHEN 2 THEN 1 ELSE 4 END AS u2, y + CASE kind WHEN 1 THEN 3 ELSE 4 END AS v2 FROM s
          UNION ALL SELECT k, kind, false, x + 2, y, x + 4, y + 1 FROM s WHERE kind = 2
          UNION ALL SELECT k, kind, true, x + 1, y + 1, x + 3, y + 3 FROM s WHERE kind = 0),
    c AS (SELECT k, sum(sign * area * (u + u2) / 2) / sum(sign * area) AS cx, sum(sign * area * (v + v2) / 2) / sum(sign * area) AS cy
          FROM (SELECT *, CASE WHEN hole THEN -1 ELSE 1 END AS sign, (u2 - u) * (v2 - v) AS area FROM r) GROUP BY k)
"""


@query(f'WITH {SHAPES} SELECT k AS "COD_POSTAL", round(cx, 9) AS x, round(cy, 9) AS y FROM c')
def shape_centroids(spark: SparkSession, folder: str) -> DataFrame:
    rows = _shapes(spark, folder).withColumn("c", S.centroid("shape"))
    return rows.select("COD_POSTAL", F.round("c.x", 9).alias("x"), F.round("c.y", 9).alias("y"))


@query(
    f"""
    WITH {SHAPES},
    -- Rectangles meet where their closed boxes do; an island lies in the hole of one frame and meets nothing else.
    pairs AS (SELECT DISTINCT a.k AS ka, b.k AS kb FROM r a JOIN r b ON a.k <> b.k AND NOT a.hole AND NOT b.hole
              AND a.u <= b.u2 AND b.u <= a.u2 AND a.v <= b.v2 AND b.v <= a.v2)
    SELECT ka AS "COD_POSTAL_1", kb AS "COD_POSTAL_2", round(sqrt(power(a.cx - b.cx, 2) + power(a.cy - b.cy, 2)), 9) AS distance
    FROM pairs JOIN c a ON a.k = ka JOIN c b ON b.k = kb
    """
)
def shape_adjacency(spark: SparkSession, folder: str) -> DataFrame:
    """Touching shapes with islands and holes: an island touches the frame around it, and nothing beyond."""
    pairs = geo.adjacency(_shapes(spark, folder), shape="shape")
    return pairs.withColumn("distance", F.round("distance", 9))


@query(
    f"""
    WITH {SHAPES},
    o AS (SELECT o_orderkey, o_orderkey % 5 = 0 AS pa, o_custkey % 4 = 0 AS pb, (o_orderkey % 19)::DOUBLE AS x, (o_custkey % 11)::DOUBLE AS y,
            o_orderkey % 200 AS ka, o_custkey % 200 AS kb FROM orders),
    e AS (SELECT k, u AS x1, v AS y1, u2 AS x2, v AS y2 FROM r UNION ALL SELECT k, u, v2, u2, v2 FROM r
          UNION ALL SELECT k, u, v, u, v2 FROM r UNION ALL SELECT k, u2, v, u2, v2 FROM r),
    ab AS (SELECT a.k AS ka, b.k AS kb, min(sqrt(power(greatest(a.x1 - b.x2, 0, b.x1 - a.x2), 2)
             + power(greatest(a.y1 - b.y2, 0, b.y1 - a.y2), 2))) AS d
           FROM e a, e b WHERE a.k < 200 AND b.k < 200 GROUP BY a.k, b.k),
    pe AS (SELECT o_orderkey, side, min(sqrt(power(greatest(x1 - x, 0, x - x2), 2) + power(greatest(y1 - y, 0, y - y2), 2))) AS d
           FROM (SELECT o_orderkey, 'b' AS side, kb AS k, x, y FROM o UNION ALL SELECT o_orderkey, 'a', ka, y, x FROM o) q
           JOIN e ON e.k = q.k GROUP BY o_orderkey, side)
    SELECT o.o_orderkey, round(111 * CASE WHEN pa AND pb THEN sqrt(2 * power(x - y, 2)) WHEN pa THEN p.d WHEN pb THEN q.d
      ELSE ab.d END, 6) AS km
    FROM o LEFT JOIN ab ON ab.ka = o.ka AND ab.kb = o.kb LEFT JOIN pe p ON p.o_orderkey = o.o_orderkey AND p.side = 'b'
      LEFT JOIN pe q ON q.o_orderkey = o.o_orderkey AND q.side = 'a'
    """
)
def geometry_km(spark: SparkSession, folder: str) -> DataFrame:
    """Distances by geometry type: points and shapes in any order."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    known = _shapes(spark, folder).where("COD_POSTAL < 200").select("COD_POSTAL", "shape")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", (o % 200).alias("ka"), (c % 200).alias("kb"))
    for side in ("a", "b"):
        rows = rows.join(known.select(F.col("COD_POSTAL").alias(f"k{side}"), F.col("shape").alias(f"s{side}")), f"k{side}", "left")

    def geometry(is_point: Column, x: Column, y: Column, shape: str) -> Column:
        return F.struct(
            F.when(is_point, "Point").otherwise("MultiPolygon").alias("type"),
            F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")).alias("point"), F.col(shape).alias("shape"),
        )

    x, y = o % 19, c % 11
    rows = rows.select("o_orderkey", geometry(o % 5 == 0, x, y, "sa").alias("a"), geometry(c % 4 == 0, y, x, "sb").alias("b"))
    return shapes.with_km(rows, "a", "b").select("o_orderkey", F.round("km", 6).alias("km"))
