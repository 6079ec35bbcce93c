"""Text functions over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query, sql
from citylake.functions import text
from citylake.operators.filters import CATEGORY_KEYWORDS, with_categories
from citylake.session import table

IT, FR = text.ITALIAN_SPANISH_LETTERS, text.FRENCH_LETTERS


def _documents(spark: SparkSession, folder: str, fn) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", fn("text").alias("fixed"))


@query(f"SELECT doc_id, {sql.fix_text('text', IT)} AS fixed FROM documents")
def fix_text(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, text.fix_text)


@query(f"SELECT doc_id, {sql.fix_french('text', FR)} AS fixed FROM documents")
def fix_french(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, text.fix_french)


@query(f"SELECT doc_id, {sql.fix_spanish('text', IT)} AS fixed FROM documents")
def fix_spanish(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, text.fix_spanish)


@query(f"SELECT doc_id, {sql.end_phrase('text')} AS fixed FROM documents")
def end_phrase(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, text.end_phrase)


@query(f"SELECT doc_id, {sql.fold('text')} AS fixed FROM documents")
def fold_text(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, text.fold_text)


@query(f"SELECT page_id, {sql.html_text('html')} AS plain FROM pages")
def html_to_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.html_text("html").alias("plain"))


@query(
    "SELECT page_id, replace(replace(replace(html, '\"', ''), '&amp;', '&'), '&Ntilde;', 'ñ') AS line "
    "FROM pages"
)
def clean_line(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.clean_line("html").alias("line"))


@query(
    f"""
    SELECT doc_id, nullif(array_to_string(list_filter(
        regexp_split_to_array(text, {sql.text('[;,' + sql.WS[1:-1] + '-]+')}),
        lambda t: regexp_matches(t, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')), '; '), '') AS mails
    FROM documents
    """
)
def extract_mails(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.extract_mails("text").alias("mails"))


@query(
    """
    WITH m AS (
      SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name
        WHEN 1 THEN lower(c_name) || '@' || lower(c_mktsegment) || '.example.com'
        WHEN 2 THEN c_name || '@local'
        WHEN 3 THEN 'a..b@' || lower(c_mktsegment) || '.org'
        ELSE lower(c_mktsegment) || '.x@' || lower(c_mktsegment) || '.org' END AS mail
      FROM customer)
    SELECT c_custkey, CASE WHEN c_custkey % 5 IN (1, 4) THEN mail END AS mail FROM m
    """
)
def valid_mail(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("c_custkey") % 5
    segment = F.lower("c_mktsegment")
    mail = (
        F.when(kind == 0, F.col("c_name"))
        .when(kind == 1, F.concat(F.lower("c_name"), F.lit("@"), segment, F.lit(".example.com")))
        .when(kind == 2, F.concat("c_name", F.lit("@local")))
        .when(kind == 3, F.concat(F.lit("a..b@"), segment, F.lit(".org")))
        .otherwise(F.concat(segment, F.lit(".x@"), segment, F.lit(".org")))
    )
    return table(spark, folder, "customer").select("c_custkey", text.valid_mail(mail).alias("mail"))


@query(
    """
    SELECT page_id, CASE WHEN page_id % 3 <> 1 THEN url END AS url,
      CASE WHEN regexp_matches(url, '^https?://[a-z0-9.-]+\\.(com|net|org)(/\\S*)?$') THEN url END AS as_is
    FROM pages
    """
)
def valid_url(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    broken = F.when(F.col("page_id") % 3 == 1, F.replace("url", F.lit("://"), F.lit(":/"))).otherwise(
        F.col("url")
    )
    return pages.select(
        "page_id", text.valid_url(broken).alias("url"), text.valid_url("url").alias("as_is")
    )


@query(
    """
    WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey,
      'dal ' || strftime(make_date(2000 + year(d) % 100, month(d), day(d)), '%-d %B %Y')
      || ' al 31-02-' || year(d) || ', (' || strftime(d, '%-d %B %Y') || ')' AS spelled
    FROM d
    """
)
def spell_dates(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("o_orderdate")
    raw = F.concat(
        F.lit("dal "), F.dayofmonth(d), F.lit("/"), F.month(d), F.lit("/"),
        F.lpad((F.year(d) % 100).cast("string"), 2, "0"), F.lit(" al 31-02-"), F.year(d), F.lit(", ("),
        F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lit("-"), F.month(d), F.lit("-"), F.year(d),
        F.lit(")"),
    )
    return table(spark, folder, "orders").select("o_orderkey", text.spell_dates(raw).alias("spelled"))


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS slashed,
      CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS mapped,
      lower(o_orderpriority) || '  x' AS normed, lower(o_orderpriority) || ' x' AS collapsed
    FROM orders
    """
)
def value_repairs(spark: SparkSession, folder: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    padded = F.concat(F.lit("  "), priority, F.lit("  X "))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.slash_to_null(F.when(status == "F", " / ").otherwise(priority)).alias("slashed"),
        text.map_values(status, {"O": "open"}).alias("mapped"),
        text.norm(padded).alias("normed"),
        text.norm(padded, collapse=True).alias("collapsed"),
    )


@query("SELECT page_id, sha256(url) AS id FROM pages")
def sha256_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.sha256("url").alias("id"))


@query(
    """
    SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: sha256(w)), ' ')
      AS hashes FROM part
    """
)
def hash_array(spark: SparkSession, folder: str) -> DataFrame:
    hashes = F.array_join(text.hash_array(F.split("p_name", " ")), " ")
    return table(spark, folder, "part").select("p_partkey", hashes.alias("hashes"))


@query(
    """
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE l_returnflag WHEN 'A' THEN 'l;M' WHEN 'N' THEN 'lunes, x' ELSE l_returnflag END
        || ' ' || CASE WHEN l_linenumber % 2 = 0 THEN 'd' ELSE 'martes' END || ';' || l_linestatus AS raw
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(array_to_string(list_filter(
      list_transform(regexp_split_to_array(raw, '[; ,]'), lambda t: upper(trim(t))),
      lambda t: t IN ('L', 'M', 'X', 'J', 'V', 'S', 'D')), ','), '') AS days FROM r
    """
)
def clean_weekdays(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    raw = F.concat(
        F.when(flag == "A", "l;M").when(flag == "N", "lunes, x").otherwise(flag),
        F.lit(" "),
        F.when(F.col("l_linenumber") % 2 == 0, "d").otherwise("martes"),
        F.lit(";"),
        F.col("l_linestatus"),
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.clean_weekdays(raw).alias("days")
    )


@query(
    f"""
    SELECT doc_id, {sql.flags("lower(concat_ws(' ', source, text))", CATEGORY_KEYWORDS)} FROM documents
    """
)
def category_flags(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return with_categories(documents, "source", "text").select("doc_id", *CATEGORY_KEYWORDS)


@query(
    f"""
    SELECT p_partkey, {sql.flags("lower(concat_ws(' ', p_name, p_type))", CATEGORY_KEYWORDS)} FROM part
    """
)
def category_flags_short(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return with_categories(part, "p_name", "p_type").select("p_partkey", *CATEGORY_KEYWORDS)
