"""Round trips through files and incremental runs, in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query
from citylake.functions.text import decode_text as decode
from citylake.operators.filters import query_events
from citylake.operators.incremental import ledger_read
from citylake.operators.pages import in_link_order
from citylake.operators.schema import apply_to, try_cast, union_all
from citylake.session import scratch, table
from citylake.sources import files
from citylake.streaming.sync import sync_exploitation, sync_trusted

EVENT_SCHEMA = "event_id bigint, user_id bigint, value double, props string"


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "csv")
    rows = table(spark, folder, "orders").drop("o_orderdate")
    files.write_csv(rows, path)
    back = apply_to(files.scan_csv(spark, path, multiline=False), try_cast("bigint"), "key$")
    return apply_to(back, try_cast("double"), "price$")


@query(
    """
    SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE c_name END AS name
    FROM customer WHERE c_custkey % 3 <> 0
    """
)
def csv_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a surplus field are skipped, rows with a missing one are completed."""
    path = scratch(spark, "csv-bad")
    form = F.col("c_custkey") % 3
    line = (
        F.when(form == 0, F.concat_ws(";", "c_custkey", "c_name", F.lit("surplus")))
        .when(form == 1, F.col("c_custkey").cast("string"))
        .otherwise(F.concat_ws(";", "c_custkey", "c_name"))
    )
    lines = table(spark, folder, "customer").select(line.alias("id;name"))
    lines.write.options(header=True, sep="\x01").csv(path)
    return files.scan_csv(spark, path, multiline=False)


@query("SELECT event_id, user_id, value, props FROM events")
def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "json")
    table(spark, folder, "events").write.json(path)
    return files.scan_json(spark, path, EVENT_SCHEMA, multiline=False)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem")
def parquet_trusted(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "trusted")
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    files.write_trusted(rows, path, partition_by="l_returnflag")
    files.write_trusted(rows.where("false"), path)
    return spark.read.parquet(path)


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name FROM customer")
def csv_header_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one folder with their columns in different orders."""
    path = scratch(spark, "csv-orders")
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    rows.where("id % 2 = 0").write.options(header=True, sep=";").csv(path)
    rows.where("id % 2 = 1").select("name", "id").write.mode("append").options(header=True, sep=";").csv(path)
    return files.scan_csv(spark, path)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def filtered_result(spark: SparkSession, folder: str) -> DataFrame:
    """A second, empty result leaves the first in place."""
    path = scratch(spark, "filtered")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for predicate in ("o_orderstatus = 'O'", "o_orderstatus = 'P'", "o_orderstatus = 'none'"):
        found = query_events(orders, predicate).drop("o_orderstatus")
        files.replace_if_nonempty(found, path=path)
    return spark.read.parquet(path)


@query(
    """
    SELECT c_custkey::VARCHAR AS id, c_name AS name, 'rome' AS city FROM customer
    UNION ALL SELECT s_suppkey::VARCHAR, 'Niño ' || s_name, 'paris' FROM supplier
    """
)
def scan_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two readable sources with different separators and encodings, one empty and one missing."""
    root = scratch(spark, "sources")
    for city, name, p, key, sep, greeting, encoding in (
        ("rome", "customer", "c", "custkey", ";", "", "UTF-8"),
        ("paris", "supplier", "s", "suppkey", "|", "Niño ", "ISO-8859-1"),
    ):
        rows = table(spark, folder, name)
        rows = rows.select(rows[f"{p}_{key}"].alias("id"), F.concat(F.lit(greeting), f"{p}_name").alias("name"))
        rows.write.options(header=True, sep=sep, encoding=encoding).csv(f"{root}/{city}")
    spark.createDataFrame([], "line string").write.text(f"{root}/barcelona")
    frames = files.scan_sources(spark, {c: f"{root}/{c}" for c in ("rome", "paris", "barcelona", "madrid")})
    return union_all(list(frames.values()))


@query(
    """
    SELECT c_custkey::VARCHAR AS id, 'Muñoz ' || c_name AS name, 'madrid' AS city FROM customer
    UNION ALL SELECT s_suppkey::VARCHAR, 'Niño ' || s_name, 'madrid' FROM supplier
    """
)
def scan_mixed_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """One folder with UTF-8 and ISO-8859-1 files: each is decoded by itself."""
    root = scratch(spark, "mixed")
    for name, key, label, greeting, encoding in (
        ("customer", "c_custkey", "c_name", "Muñoz ", "UTF-8"), ("supplier", "s_suppkey", "s_name", "Niño ", "ISO-8859-1"),
    ):
        rows = table(spark, folder, name).select(F.col(key).alias("id"), F.concat(F.lit(greeting), label).alias("name"))
        rows.write.mode("append").options(header=True, sep=";", encoding=encoding).csv(root)
    return files.scan_sources(spark, {"madrid": root})["madrid"]


@query(
    """
    WITH p AS (SELECT c_custkey, c_custkey // 10 AS page FROM customer)
    SELECT c_custkey AS id, CASE WHEN page < 7 THEN page WHEN page > 7 THEN page - 8 END AS page_no,
      CASE WHEN page < 7 THEN 'page/0' WHEN page > 7 THEN 'page/8' END AS chain FROM p WHERE page <> 7
    """
)
def pages_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of ten records in a ``data`` envelope, landed in any order; page 7 is missing, so page 8 begins a chain."""
    path = scratch(spark, "pages")
    rows = table(spark, folder, "customer").select("c_custkey", F.floor(F.col("c_custkey") / 10).alias("page"))
    last = rows.agg(F.max("page")).first()[0]
    link = lambda n: F.concat(F.lit("page/"), n.cast("string"))
    pages = rows.groupBy("page").agg(F.collect_list(F.struct(F.col("c_custkey").alias("id"))).alias("data"))
    following = F.when(F.col("page") < last, link(F.col("page") + 1))
    landed = pages.where("page <> 7").select("data", F.struct(link(F.col("page")).alias("self"), following.alias("next")).alias("links"))
    landed.repartition(4, F.xxhash64("data")).write.json(path)
    schema = "data array<struct<id:bigint>>, links struct<self:string,next:string>"
    read = files.scan_json(spark, path, schema, multiline=False).select("data", F.col("links.self").alias("self"), F.col("links.next").alias("next"))
    return in_link_order(read, "self", "next").select(F.inline("data"), "page_no", "chain")


@query("SELECT DISTINCT 'weather' AS data_type, 'city=' || event_type AS city FROM events")
def list_zone(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch(spark, "trusted_zone")
    events = table(spark, folder, "events").withColumnRenamed("event_type", "city")
    for feed in ("weather", "accommodation"):
        events.select("city", "event_id").write.partitionBy("city").parquet(f"{root}/{feed}")
    return files.list_zone(spark, root, "weather").select("data_type", "city").distinct()


@query("SELECT page_id, split_part(url, '/', -3) AS data_type, split_part(url, '/', -2) AS city, split_part(url, '/', -1) AS file_name FROM pages")
def split_path(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id", *[c.alias(n) for n, c in files.split_path(F.col("url")).items()]
    )


@query("SELECT doc_id, text FROM documents")
def decode_text(spark: SparkSession, folder: str) -> DataFrame:
    charset = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(
        F.encode("text", "ISO-8859-1")
    )
    return table(spark, folder, "documents").select("doc_id", decode(charset).alias("text"))


def _land(spark: SparkSession, folder: str, root: str, where: str, mode: str) -> None:
    rows = table(spark, folder, "events").where(where).drop("ts")
    rows.write.mode(mode).partitionBy("event_type").json(f"{root}/landing_zone/events")


def _city(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep, "event_id", "user_id", "value", F.regexp_replace("city", "^event_type=", "").alias("city")
    )


@query("SELECT event_id, user_id, value, event_type AS city FROM events")
def sync_trusted_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings and a rerun: every file is processed once."""
    root = scratch(spark, "sync")
    target = f"{root}/trusted_zone/events"
    for where in ("value < 5 OR value IS NULL", "value >= 5", None):
        if where:
            _land(spark, folder, root, where, "append")
        sync_trusted(
            spark, f"{root}/landing_zone/events", target, f"{root}/checkpoint", EVENT_SCHEMA, _city,
            multiline=False,
        )
    return spark.read.schema("event_id bigint, user_id bigint, value double, city string").parquet(target)


@query(
    """
    SELECT event_id, user_id, value, event_type AS city, true AS logged FROM events
    """
)
def sync_exploitation_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings, a lost checkpoint, a rerun, a third landing: every file once, none lost."""
    root = scratch(spark, "exploit")
    paths = {n: f"{root}/{n}" for n in ("table", "ledger")}
    src = f"{root}/landing_zone/events"

    for run, where in enumerate(("value < 5 OR value IS NULL", "value >= 5 AND value < 50", None, "value >= 50")):
        if where:
            _land(spark, folder, root, where, "append")
        sync_exploitation(
            spark, "events", src, paths["table"], paths["ledger"], f"{root}/checkpoint-{run // 2}",
            EVENT_SCHEMA, lambda df: _city(df, "file_key"), "json", multiline=False,
        )
    rows = spark.read.parquet(paths["table"]).drop("batch")
    logged = ledger_read(spark, paths["ledger"]).select("file_key", F.lit(True).alias("logged"))
    return rows.join(logged, "file_key", "left").drop("file_key")
