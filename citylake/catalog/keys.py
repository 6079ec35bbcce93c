"""Deduplication, bookkeeping and lookup joins over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query
from citylake.operators import dedupe as D
from citylake.operators import enrich as E
from citylake.operators import incremental as I
from citylake.session import table


@query(
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """
)
def latest_event_per_user(spark: SparkSession, folder: str) -> DataFrame:
    rows = D.latest_per_key(table(spark, folder, "events"), "user_id", "ts", ["event_id"])
    return rows.select("user_id", "event_id", "event_type", "value")


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """
)
def latest_order_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    rows = D.latest_per_key(table(spark, folder, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return D.distinct_postcodes(table(spark, folder, "customer"), "c_mktsegment", "c_nationkey")


@query("SELECT DISTINCT p_brand AS \"POSTAL_CODE\" FROM part")
def code_table(spark: SparkSession, folder: str) -> DataFrame:
    return D.code_table(table(spark, folder, "part"), "p_brand")


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return rows.dropDuplicates()


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY text")
def dedupe_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = D.dedupe(table(spark, folder, "documents").select("doc_id", "text"), ["text"], ["doc_id"])
    return rows.select("doc_id", F.sha2("text", 256).alias("digest"))


@query(
    """
    WITH r AS (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN user_id END AS user_id, event_type
               FROM events)
    SELECT min(event_id) AS event_id, user_id, event_type FROM r WHERE user_id IS NOT NULL
      GROUP BY user_id, event_type
    UNION ALL SELECT event_id, user_id, event_type FROM r WHERE user_id IS NULL
    """
)
def dedupe_keep_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    user = F.when(F.col("event_id") % 3 > 0, F.col("user_id")).alias("user_id")
    rows = table(spark, folder, "events").select("event_id", user, "event_type")
    return D.dedupe(rows, ["user_id", "event_type"], ["event_id"], null_keys="keep")


@query(
    """
    WITH p AS (SELECT DISTINCT l_returnflag AS city_code_name,
                 lpad((l_partkey % 40000)::VARCHAR, 5, '0') AS z FROM lineitem)
    SELECT city_code_name, row_number() OVER (PARTITION BY city_code_name ORDER BY z) AS position,
      z AS postcode FROM p
    """
)
def list_per_group(spark: SparkSession, folder: str) -> DataFrame:
    code = F.lpad((F.col("l_partkey") % 40000).cast("string"), 5, "0")
    rows = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("city_code_name"), code.alias("property_postalcode")
    )
    return D.postcodes_by_city(rows).withColumnRenamed("property_postalcode", "postcode")


@query(
    """
    SELECT count(*) AS rows, count(o_orderkey) AS o_orderkey_present,
      count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS state_present FROM orders
    """
)
def profile(spark: SparkSession, folder: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    return D.profile(table(spark, folder, "orders").select("o_orderkey", state.alias("state")))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def limit_by_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").orderBy("o_orderkey").limit(10)
    return rows.select("o_orderkey", "o_totalprice")


@query(
    """
    SELECT 'documents/' || source || '/' || doc_id || '.json' AS file_key FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """
)
def pending_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    name = F.concat(F.col("doc_id"), F.lit(".json"))
    files = documents.select(
        "doc_id", I.ledger_key(F.lit("documents"), F.col("source"), name).alias("file_key")
    )
    logged = files.join(table(spark, folder, "labels"), "doc_id", "left_semi")
    return I.pending(files, logged).select("file_key")


@query(
    """
    SELECT DISTINCT 'orders/' || o_custkey || '.json' AS path FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    """
)
def missing_in_next_zone(spark: SparkSession, folder: str) -> DataFrame:
    def paths(df: DataFrame, zone: str, key: str) -> DataFrame:
        path = F.concat(F.lit(f"lake/{zone}/orders/"), F.col(key), F.lit(".json"))
        return df.select(I.relative_path(path, zone).alias("path")).distinct()

    landing = paths(table(spark, folder, "orders"), "landing_zone", "o_custkey")
    trusted = paths(table(spark, folder, "customer").where("c_acctbal > 0"), "trusted_zone", "c_custkey")
    return I.missing_in(landing, trusted)


@query(
    """
    WITH old AS (SELECT user_id, event_id, value FROM events WHERE user_id % 3 > 0
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
         new AS (SELECT user_id, event_id, value FROM events
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
    SELECT * FROM old UNION ALL SELECT * FROM new WHERE user_id NOT IN (SELECT user_id FROM old)
    """
)
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    columns = ["user_id", "event_id", "value"]
    old = D.dedupe(events.where("user_id % 3 > 0").select(columns), ["user_id"], ["event_id"])
    new = events.select(columns)
    return I.insert_if_absent(old, new, "user_id", ["event_id"])


@query("SELECT vec_id AS id FROM embeddings WHERE label % 2 = 1")
def missing_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    ids = vectors.select(F.col("vec_id").alias("id"))
    stored = vectors.where("label % 2 = 0").select(F.col("vec_id").alias("id"))
    return I.missing_vectors(ids, stored)


@query(
    """
    SELECT s_name AS city, strftime(d, '%Y-%m-%d') AS day, strftime(d - 365, '%Y-%m-%d') AS until,
      'weather/' || s_name || '/' || strftime(d - 365, '%Y-%m-%d') || '.json' AS file_key,
      'landing_zone/weather/' || s_name || '/' || strftime(d - 365, '%Y-%m-%d') || '.json' AS landing_path
    FROM (SELECT s_name, unnest([DATE '2025-07-05', DATE '2025-07-06', DATE '2025-07-07']) AS d FROM supplier)
    """
)
def work_list_weather(spark: SparkSession, folder: str) -> DataFrame:
    cities = table(spark, folder, "supplier").select(F.col("s_name").alias("city"))
    rows = I.work_list(cities, "2025-07-05", "2025-07-07", "weather")
    return rows.select(
        "city", F.col("day").cast("string").alias("day"), F.col("until").cast("string").alias("until"),
        "file_key", "landing_path",
    )


@query(
    """
    SELECT c_name AS city, 'accommodation/' || c_name || '/' || strftime(d, '%Y-%m-%d') || '_'
      || strftime(d + 1, '%Y-%m-%d') || '.json' AS file_key
    FROM (SELECT c_name, unnest([DATE '2025-07-05', DATE '2025-07-06']) AS d FROM customer)
    """
)
def work_list_accommodation(spark: SparkSession, folder: str) -> DataFrame:
    cities = table(spark, folder, "customer").select(F.col("c_name").alias("city"))
    rows = I.work_list(cities, "2025-07-05", "2025-07-06", "accommodation")
    return rows.select("city", "file_key")


@query(
    """
    WITH fix AS (SELECT o_custkey, o_orderpriority AS a,
                   CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS p
                 FROM orders WHERE o_totalprice > 200000
                 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    SELECT c_custkey AS hotel_id,
      CASE WHEN o_custkey IS NOT NULL THEN a ELSE c_name END AS property_address,
      CASE WHEN o_custkey IS NOT NULL THEN p ELSE c_mktsegment END AS property_postalcode
    FROM customer LEFT JOIN fix ON c_custkey = o_custkey
    """
)
def apply_addresses(spark: SparkSession, folder: str) -> DataFrame:
    hotels = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("hotel_id"), F.col("c_name").alias("property_address"),
        F.col("c_mktsegment").alias("property_postalcode"),
    )
    status, useful = F.col("o_orderstatus"), F.col("o_totalprice") > 200000
    repairs = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("hotel_id"),
        F.when(useful, F.col("o_orderpriority")).alias("property_address"),
        F.when(useful & (status != "F"), status).alias("property_postalcode"),
        "o_orderkey",
    )
    return E.apply_addresses(hotels, repairs, latest=[F.col("o_orderkey")])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE l_returnflag END AS flag,
      CASE WHEN l_linestatus = 'F' THEN ' ' ELSE 'open' END AS status
    FROM lineitem
    """
)
def translate_values(spark: SparkSession, folder: str) -> DataFrame:
    # Entries come from the orders' own codes, twice each, plus one without a target.
    codes = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("source"))
    states = table(spark, folder, "lineitem").select(F.col("l_linestatus").alias("source"))
    target = (
        F.when(F.col("source") == "A", "accepted")
        .when(F.col("source") == "R", "returned")
        .when(F.col("source") == "O", "open")
    )
    dictionary = codes.union(states).distinct().withColumn("target", target)
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linestatus") == "F", " ").otherwise(F.col("l_linestatus")).alias("status"),
    )
    return E.translate(rows, ["flag", "status"], dictionary)


@query(
    """
    SELECT p_partkey, i - 1 AS position, w AS url, sha256(w) AS hash
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w,
            unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part)
    """
)
def photo_pairs(spark: SparkSession, folder: str) -> DataFrame:
    hotels = table(spark, folder, "part").withColumn("urls", F.split("p_name", " "))
    rows = E.photo_pairs(hotels, "p_partkey", "urls")
    return rows.withColumn("position", F.col("position").cast("bigint"))
