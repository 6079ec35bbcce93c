"""Schema, projection and filter operators over the provided tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query
from citylake.functions import numeric
from citylake.operators import filters
from citylake.operators import schema as S
from citylake.session import table


def _nested(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(
                F.col("c_acctbal").alias("value"), F.struct(F.col("c_mktsegment").alias("code")).alias("s")
            ).alias("price"),
        ).alias("property"),
        F.col("c_custkey").alias("id"),
    )


@query("SELECT c_custkey AS id, c_name AS property_name, c_acctbal AS property_price_value FROM customer")
def flatten_one_level(spark: SparkSession, folder: str) -> DataFrame:
    flat = S.flatten(_nested(spark, folder))
    return S.flatten(flat).select("id", "property_name", "property_price_value")


@query(
    """
    SELECT c_name AS property_name, c_acctbal AS property_price_value,
      c_mktsegment AS property_price_s_code, c_custkey AS id FROM customer
    """
)
def flatten_nested(spark: SparkSession, folder: str) -> DataFrame:
    return S.flatten(_nested(spark, folder), depth=3, in_order=True)


@query(
    """
    SELECT c_custkey::INT AS id, c_name AS name, NULL::INT AS bad, NULL::DOUBLE AS absent,
      c_acctbal AS balance, c_custkey % 2 = 0 AS even, array_to_string([c_name, c_mktsegment], '|') AS tags
    FROM customer
    """
)
def conform_schema(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("bad"),
        F.col("c_acctbal").alias("balance"),
        (F.col("c_custkey") % 2 == 0).alias("even"),
        F.array("c_name", "c_mktsegment").alias("tags"),
        F.col("c_nationkey").alias("extra"),
    )
    schema = S.schema_from_dict(
        {"id": "int", "name": "str", "bad": "int", "absent": "float", "balance": "float",
         "even": "bool", "tags": ["unknown"]}
    )
    return S.conform(rows, schema).withColumn("tags", F.array_join("tags", "|"))


@query(
    """
    SELECT event_id, user_id, 'k' AS name, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
    UNION ALL
    SELECT event_id, user_id, 'value' AS name, NULL::INT AS k FROM events
    """
)
def unnest_records(spark: SparkSession, folder: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]

    def record(name: str, value: Column) -> Column:
        return F.struct("event_id", "user_id", F.lit(name).alias("name"), value.alias("k"))

    pages = table(spark, folder, "events").select(
        F.struct(F.array(record("k", k), record("value", F.lit(None).cast("int"))).alias("records")).alias(
            "result"
        )
    )
    return S.unnest_records(pages, "result.records", ["event_id", "user_id", "name", "k"])


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def unnest_array(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "part").select(
        F.struct(
            F.transform(
                F.split("p_name", " "), lambda w: F.struct(F.col("p_partkey"), w.alias("word"))
            ).alias("hotels")
        ).alias("data")
    )
    return S.unnest(documents, "data.hotels").select("item.p_partkey", "item.word")


@query(
    """
    SELECT l_orderkey::DOUBLE AS l_orderkey, l_partkey::DOUBLE AS l_partkey,
      l_suppkey AS l_suppkey, l_linenumber, l_quantity,
      lower(l_returnflag) AS l_returnflag, lower(l_linestatus) AS l_linestatus
    FROM lineitem
    """
)
def regex_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus",
    )
    rows = S.apply_to(rows, S.try_cast("double"), "KEY", "bigint", exclude=["l_suppkey"])
    return S.apply_to(rows, F.lower, "(flag|status)", "string")


@query(
    """
    SELECT o_orderkey AS id, o_orderpriority AS name, 'not avl' AS email, 'paris' AS city,
      o_totalprice AS price, '2025-01-01' AS start_date, '9999-12-31' AS end_date FROM orders
    """
)
def rename_select(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").drop("o_orderdate")
    rows = S.normalise_names(rows.withColumnRenamed("o_orderkey", " O_ORDERKEY "))
    rows = S.open_validity(S.tag(S.ensure_columns(rows, ["email"]), "city", "paris"))
    rows = S.rename_select(
        rows,
        {"o_orderkey": "id", "o_orderpriority": "name", "o_totalprice": "price"},
        ["id", "name", "email", "city", "price", "start_date", "end_date"],
    )
    return S.apply_to(rows, lambda c: c.cast("string"), "_date$")


@query(
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
    """
)
def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    frames = [
        table(spark, folder, name).select(
            F.col(f"{p}_{key}").alias("id"), F.col(f"{p}_name").alias("name"),
            F.col(f"{p}_nationkey").alias("nation"),
        )
        for name, p, key in (("customer", "c", "custkey"), ("supplier", "s", "suppkey"))
    ]
    return S.union_all(frames)


@query(
    """
    WITH h AS (SELECT o_orderkey, unnest([0, 1, 2]) AS i, o_orderdate, o_totalprice FROM orders)
    SELECT o_orderkey, strftime(o_orderdate + to_hours(i), '%Y-%m-%dT%H:%M') AS timestamp,
      strftime(o_orderdate + to_hours(i), '%H:%M') AS time, o_totalprice + i AS rain,
      CASE WHEN i = 0 THEN 5 ELSE NULL END AS cloud
    FROM h WHERE i < o_orderkey % 3
    """
)
def unpivot_hourly(spark: SparkSession, folder: str) -> DataFrame:
    hours = F.sequence(F.lit(0), F.lit(2))
    stamp = F.transform(
        hours,
        lambda i: F.date_format(
            F.col("o_orderdate") + F.make_dt_interval(F.lit(0), i), "yyyy-MM-dd'T'HH:mm"
        ),
    )
    rain = F.transform(hours, lambda i: F.col("o_totalprice") + i)
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.struct(
            stamp.alias("time"),
            F.slice(rain, F.lit(1), (F.col("o_orderkey") % 3).cast("int")).alias("rain"),
            F.array(F.lit(5), F.lit(None), F.lit(None), F.lit(7)).alias("cloud"),
        ).alias("hourly"),
    )
    return S.unpivot_hourly(rows)


def _positions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 3 != 0, F.col("o_totalprice")).alias("lat"),
        F.when(key % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("lon"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).alias("address"),
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 'no' ELSE 'yes' END
      AS position FROM orders
    """
)
def position_flag(spark: SparkSession, folder: str) -> DataFrame:
    rows = filters.with_position_flag(_positions(spark, folder), "lat", "lon", "position")
    return rows.select("o_orderkey", "position")


@query("SELECT o_orderkey, o_totalprice AS lat FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0")
def has_position(spark: SparkSession, folder: str) -> DataFrame:
    return filters.has_position(_positions(spark, folder), "lat", "lon").select("o_orderkey", "lat")


@query(
    """
    SELECT o_orderkey FROM orders
    WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0
    """
)
def drop_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    return filters.drop_incomplete(_positions(spark, folder)).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 7 = 0")
def needs_address(spark: SparkSession, folder: str) -> DataFrame:
    return filters.needs_address(_positions(spark, folder), "address", "lat").select("o_orderkey")


@query("SELECT o_orderkey, o_orderpriority AS address FROM orders WHERE o_orderkey % 7 <> 0")
def present_key(spark: SparkSession, folder: str) -> DataFrame:
    return filters.present(_positions(spark, folder), "address").select("o_orderkey", "address")


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' OR o_custkey IN
      (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """
)
def member_or(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    rows = filters.in_list_or(
        table(spark, folder, "orders"), "o_custkey", ids, "c_custkey", F.col("o_orderstatus") == "P"
    )
    return rows.select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40")
def predicate_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = filters.query_events(table(spark, folder, "lineitem"), "l_returnflag = 'R' AND l_quantity > 40")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """
    SELECT vec_id, position, value FROM (
      SELECT vec_id, unnest(range(len(embedding))) AS position,
        unnest(list_transform(v, lambda x: (x / n)::FLOAT::DOUBLE)) AS value
      FROM (SELECT vec_id, embedding, v, sqrt(list_reduce(list_transform(v, lambda x: x * x),
              lambda a, b: a + b, 0.0::DOUBLE)) AS n
            FROM (SELECT vec_id, embedding,
                    list_transform(embedding, lambda x: x::DOUBLE / 255.0::DOUBLE) AS v FROM embeddings)))
    """
)
def l2_normalise(spark: SparkSession, folder: str) -> DataFrame:
    unit = numeric.l2_normalise("embedding", 255.0)
    rows = table(spark, folder, "embeddings").select("vec_id", F.posexplode(unit).alias("position", "value"))
    return rows.select(
        "vec_id", F.col("position").cast("bigint").alias("position"),
        F.col("value").cast("double").alias("value"),
    )
