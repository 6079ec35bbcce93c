"""Postal, date and number functions over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query
from citylake.functions import numeric, postal, temporal
from citylake.session import table


@query(
    """
    SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) < 5 THEN lpad(c_custkey::VARCHAR, 5, '0')
      ELSE c_custkey::VARCHAR END AS zip, 'x' || c_custkey || '.0' AS longer FROM customer
    """
)
def pad_zip(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        "c_custkey",
        postal.pad_zip(key).alias("zip"),
        F.concat(F.lit("x"), postal.pad_zip(F.concat(key, F.lit(".0000")))).substr(
            F.lit(1), F.length(key) + 3
        ).alias("longer"),
    )


@query(
    """
    WITH r AS (SELECT o_orderkey, o_orderkey % 30 AS k, o_orderkey % 4 AS form FROM orders)
    SELECT o_orderkey,
      CASE WHEN form < 3 AND k BETWEEN 1 AND 20 THEN (75000 + k)::INT END AS paris,
      CASE WHEN form < 2 AND k BETWEEN 1 AND 29 THEN (8000 + k)::INT END AS barcelona,
      CASE WHEN form < 3 AND k >= 1 THEN (28000 + k)::INT END AS madrid
    FROM r
    """
)
def postcode_range(spark: SparkSession, folder: str) -> DataFrame:
    k, form = F.col("o_orderkey") % 30, F.col("o_orderkey") % 4

    def code(base: int):
        whole = (k + base).cast("string")
        return (
            F.when(form == 0, whole)
            .when(form == 1, F.concat(F.lit(" "), whole, F.lit(".9 ")))
            .when(form == 2, F.concat(whole, F.lit("e0")))
            .otherwise(F.concat(whole, F.lit("d")))
        )

    town = F.when(form == 2, "Madrid").otherwise(" Barcelona")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        postal.paris_postcode(code(75000), F.lit("Paris ")).alias("paris"),
        postal.barcelona_postcode(code(8000), town).alias("barcelona"),
        postal.madrid_postcode(code(28000)).alias("madrid"),
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN starts_with(z, '28') THEN 'Madrid' WHEN starts_with(z, '08')
      THEN 'Barcelona' ELSE 'Otro' END AS city
    FROM (SELECT o_orderkey, lpad((o_orderkey % 40000)::VARCHAR, 5, '0') AS z FROM orders)
    """
)
def prefix_class(spark: SparkSession, folder: str) -> DataFrame:
    code = postal.pad_zip(F.col("o_orderkey") % 40000)
    return table(spark, folder, "orders").select(
        "o_orderkey", postal.city_of_postcode(code).alias("city")
    )


@query(
    """
    SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
    FROM events
    """
)
def parse_ts(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.col("ts").cast("string")
    raw = F.when(F.col("event_id") % 3 == 0, F.replace(raw, F.lit(" "), F.lit("T"))).otherwise(raw)
    parsed = F.date_format(temporal.parse_ts(raw), temporal.STAMP)
    return table(spark, folder, "events").select("event_id", parsed.alias("parsed"))


@query(
    """
    SELECT event_id, strftime(ts, '%H:%M') AS hour, strftime(ts, '%H:%M') AS zoned,
      NULL::VARCHAR AS bad FROM events
    """
)
def hour_of(spark: SparkSession, folder: str) -> DataFrame:
    iso = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
    return table(spark, folder, "events").select(
        "event_id",
        temporal.hour_of(iso).alias("hour"),
        temporal.hour_of(F.concat(iso, F.lit("+02:00"))).alias("zoned"),
        temporal.hour_of(F.substring(iso, 12, 20)).alias("bad"),
    )


@query(
    """
    SELECT o_orderkey, strftime(d + 1, '%Y-%m-%d') AS departure, strftime(d - 365, '%Y-%m-%d') AS weather,
      strftime(d - INTERVAL 1 YEAR, '%Y-%m-%d') AS last_year
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    """
)
def date_shift(spark: SparkSession, folder: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        temporal.departure_day(day).cast("string").alias("departure"),
        temporal.weather_day(day).cast("string").alias("weather"),
        temporal.same_day_last_year(day).cast("string").alias("last_year"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_extendedprice, 0)::BIGINT AS rounded,
      round_even(l_partkey + 0.5::DOUBLE, 0)::BIGINT AS half FROM lineitem
    """
)
def round_coord(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numeric.round_coord("l_extendedprice").alias("rounded"),
        numeric.round_coord(F.concat(F.col("l_partkey"), F.lit(".5"))).alias("half"),
    )


@query(
    """
    SELECT c_custkey, c_acctbal AS lat,
      CASE WHEN c_custkey % 3 <> 0 THEN c_custkey + 0.25::DOUBLE END AS lon FROM customer
    """
)
def split_latlon(spark: SparkSession, folder: str) -> DataFrame:
    second = F.when(F.col("c_custkey") % 3 == 0, "x").otherwise(F.concat("c_custkey", F.lit(".25")))
    pair = numeric.split_latlon(F.concat(F.col("c_acctbal").cast("string"), F.lit(", "), second))
    return table(spark, folder, "customer").withColumn("p", pair).select("c_custkey", "p.lat", "p.lon")


@query(
    """
    SELECT c_custkey, (c_nationkey + 0.5::DOUBLE) * 1e7::DOUBLE AS x,
      CASE WHEN c_custkey % 2 = 0 THEN (c_custkey + 0.25::DOUBLE) * 1e7::DOUBLE END AS y FROM customer
    """
)
def scaled_coords(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.concat(
        F.col("c_nationkey"), F.lit(".5, "), F.col("c_custkey"),
        F.when(F.col("c_custkey") % 2 == 0, ".25").otherwise("?"),
    )
    customer = table(spark, folder, "customer").withColumn("p", numeric.scaled_coords(raw))
    return customer.select("c_custkey", "p.x", "p.y")


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN o_totalprice END AS price,
      CASE WHEN o_orderkey % 4 <= 1 THEN trunc(o_totalprice)::BIGINT END AS whole FROM orders
    """
)
def to_numeric(spark: SparkSession, folder: str) -> DataFrame:
    form = F.col("o_orderkey") % 4
    raw = F.col("o_totalprice").cast("string")
    raw = (
        F.when(form == 0, raw)
        .when(form == 1, F.concat(F.lit(" "), raw, F.lit("\t")))
        .when(form == 2, F.concat(raw, F.lit("f")))
        .otherwise("n/a")
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", numeric.to_numeric(raw).alias("price"), numeric.to_long(raw).alias("whole")
    )


@query(
    """
    SELECT c_custkey, CASE WHEN c_nationkey > 5 THEN
      'POINT(' || c_acctbal || ' ' || (c_nationkey + 0.5::DOUBLE) || ')' END AS point FROM customer
    """
)
def point_wkt(spark: SparkSession, folder: str) -> DataFrame:
    lat = F.when(F.col("c_nationkey") > 5, F.col("c_nationkey") + F.lit(0.5))
    return table(spark, folder, "customer").select(
        "c_custkey", numeric.point_wkt("c_acctbal", lat).alias("point")
    )
