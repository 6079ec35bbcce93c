"""The user-level pipelines over feeds derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query, sql
from citylake.catalog.geo import _square
from citylake.functions.text import FRENCH_LETTERS as FR
from citylake.functions.text import ITALIAN_SPANISH_LETTERS as IT
from citylake.operators.filters import CATEGORY_KEYWORDS
from citylake.operators.schema import apply_to
from citylake.plans import accommodation as A
from citylake.plans import cultural as C
from citylake.plans import events as E
from citylake.plans import image_vectors as V
from citylake.plans import postal_graph as P
from citylake.plans import weather as W
from citylake.session import scratch, table
from citylake.sources import files

FLAGS = sql.flags("lower(concat_ws(' ', name, description))", CATEGORY_KEYWORDS)


def _texts(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    return apply_to(df, lambda c: c.cast("string"), "_date$")


def _priority_words(spark: SparkSession, folder: str, prefix: str, target: str, lower: bool = False) -> DataFrame:
    found = table(spark, folder, "orders").where("o_orderpriority LIKE '1%'").select("o_orderpriority").distinct()
    name = F.lower("o_orderpriority") if lower else F.col("o_orderpriority")
    return found.select(F.concat(F.lit(prefix), name).alias("source"), F.lit(target).alias("target"))


def rome_feed(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("doc_id")
    return table(spark, folder, "documents").select(
        k.alias("_id"),
        k.cast("string").alias("id_"),
        F.when(k % 50 == 0, "/").otherwise(F.concat(F.lit("festa "), F.floor(k / 2).cast("string"))).alias(
            "Denominazione"
        ),
        F.concat(F.col("text"), F.lit(" -")).alias("Descrizione"),
        F.concat(F.lit(" Via  Roma ,"), k, F.lit(".lazio ")).alias("Indirizzo"),
        F.concat(F.lit("Info@x.it; "), F.col("source"), F.lit("-a@b.it")).alias("Mail"),
        F.when(k % 2 == 0, " / ").otherwise("www").alias("Sito web"),
        F.lit("si").alias("Zona Wi-Fi"),
        F.col("lang").alias("Partner"),
        F.when(k % 7 == 0, "n/a").otherwise(F.concat(F.lit("41."), k)).alias("Latitudine"),
        F.concat(F.lit("12."), k % 90 + 10).alias("Longitudine"),
        F.lit("Rome").alias("city"),
    )


@query(
    f"""
    WITH raw AS (
      SELECT doc_id AS k, CASE WHEN doc_id % 50 = 0 THEN NULL ELSE 'festa ' || doc_id // 2 END AS name,
        text, source FROM documents
      QUALIFY row_number() OVER (PARTITION BY name ORDER BY doc_id::VARCHAR, doc_id) = 1),
    r AS (SELECT k::VARCHAR AS id, CASE WHEN k // 2 % 3 = 0 THEN 'feast ' || k // 2 ELSE name END AS name,
        {sql.end_phrase("text || ' -'")} AS description,
        'via roma, ' || CASE WHEN k >= 0 THEN k::VARCHAR END || '. lazio' AS address,
        'info@x. it' AS mail_fixed, source,
        CASE WHEN k % 2 = 1 THEN 'www' END AS website, 'rome' AS city,
        'POINT(' || ('12.' || (k % 90 + 10))::DOUBLE || ' ' || ('41.' || k)::DOUBLE || ')' AS "Point"
      FROM raw WHERE k % 7 <> 0)
    SELECT id, name, description, address, NULL::VARCHAR AS email, website, city,
      '2025-01-01' AS start_date, '9999-12-31' AS end_date, "Point", {FLAGS} FROM r
    """
)
def rome_events(spark: SparkSession, folder: str) -> DataFrame:
    """Names of every third pair of documents are in the dictionary."""
    k = F.floor(F.col("doc_id") / 2)
    words = table(spark, folder, "documents").where(k % 3 == 0).select(
        F.concat(F.lit("festa "), k).alias("source"), F.concat(F.lit("feast "), k).alias("target")
    )
    return _texts(E.rome_events(E.rome_trusted(rome_feed(spark, folder)), words))


def paris_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw pages as event rows, every fourth one twice."""
    k = F.col("page_id")
    copies = F.explode(F.when(k % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    stamp = F.concat(F.lit("2025-06-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    return table(spark, folder, "pages").select("*", copies.alias("copy")).select(
        k.cast("string").alias("ID"),
        F.concat(F.lit("<b>"), F.col("url"), F.lit("</b>&amp;")).alias("Titre"),
        F.when(k % 3 == 1, F.concat(F.lit("<h1>Festival</h1>"), F.col("html")))
        .otherwise(F.col("html")).alias("Description"),
        F.concat(F.lit("  Rue  "), k, F.lit(" ,paris")).alias("Adresse du lieu"),
        F.lit("<i> Paris </i>").alias("Ville"),
        F.lit("75004").alias("Code postal"),
        F.when(k % 5 == 0, "unknown").otherwise(F.concat(F.lit("48."), k, F.lit(", 2.5"))).alias(
            "Coordonnées géographiques"
        ),
        F.when(k % 3 == 0, "no url").otherwise(F.col("url")).alias("URL"),
        F.concat(stamp, F.lit(" 09:00:00.0")).alias("Date de début"),
        F.concat(stamp, F.lit("T10:00:00")).alias("Date de fin"),
    )


DESCRIPTION = "CASE WHEN page_id % 3 = 1 THEN '<h1>Festival</h1>' || html ELSE html END"
PARIS_SQL = f"""
    WITH r AS (
      SELECT page_id AS id,
        {sql.fix_french(sql.html_text("'<b>' || url || '</b>&amp;'"), FR)} AS name,
        {sql.fix_french(sql.html_text(DESCRIPTION), FR)} AS description,
        CASE WHEN page_id % 2 = 0 THEN 'street ' || page_id ELSE 'rue ' || page_id || ', paris' END AS address,
        'not avl' AS email,
        CASE WHEN page_id % 3 <> 0 THEN lower(trim(url)) END AS website, 'paris' AS city,
        '2025-06-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || ' 09:00:00' AS start_date,
        NULL::VARCHAR AS end_date,
        'POINT(2.5 ' || ('48.' || page_id)::DOUBLE || ')' AS "Point"
      FROM pages WHERE page_id % 5 <> 0)
    SELECT *, {FLAGS} FROM r
"""


@query(PARIS_SQL)
def paris_events(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of even pages are in the dictionary."""
    k = F.col("page_id")
    words = table(spark, folder, "pages").where(k % 2 == 0).select(
        F.concat(F.lit("rue "), k, F.lit(", paris")).alias("source"), F.concat(F.lit("street "), k).alias("target")
    )
    return _texts(E.paris_events(E.paris_trusted(paris_feed(spark, folder)), words))


@query(f'SELECT * FROM ({PARIS_SQL}) WHERE "SOCIAL_LIFE" = 1')
def event_query_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Paris pages to the stored exploitation table, its social rows to the result table: the flagship query."""
    root = scratch(spark, "paris")
    events = paris_events(spark, folder)
    files.write_trusted(events, f"{root}/paris_expl")
    stored = spark.read.schema(events.schema).parquet(f"{root}/paris_expl")
    found = E.filtered_events(stored, "SOCIAL_LIFE = 1")
    if not files.replace_if_nonempty(found, path=f"{root}/paris_filtered"):
        return found
    return spark.read.schema(found.schema).parquet(f"{root}/paris_filtered")


def barcelona_feed(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    date = F.col("o_orderdate")
    changed = date + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k % 86400).cast("decimal(18,6)"))
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("register_id"),
        F.concat(F.lit("fira "), k, F.lit(" ,bar?")).alias("name"),
        date.cast("string").alias("created"),
        changed.cast("string").alias("modified"),
        F.lit("08001").alias("addresses_zip_code"),
        F.lit("BARCELONA").alias("addresses_town"),
        F.concat(F.lit(" Carrer "), k).alias("addresses_main_address"),
        F.concat(F.lit("Museu "), F.col("o_orderpriority")).alias("values_description"),
        F.when(k % 3 == 0, F.lit(None)).otherwise("41.4").alias("geo_epgs_4326_lat"),
        F.lit("2.1").alias("geo_epgs_4326_lon"),
        date.cast("string").alias("start_date"),
        F.lit("nan").alias("end_date"),
        F.lit("Barcelona").alias("city"),
    )


@query(
    f"""
    WITH l AS (SELECT *, '¿Fira ' || o_orderkey || ', bar?' AS name FROM orders
               QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
                 o_orderkey % 86400 DESC, name DESC) = 1),
    r AS (SELECT o_custkey AS id, name, CASE WHEN o_orderpriority LIKE '1%' THEN 'museum one' ELSE 'museu ' || lower(o_orderpriority) END
        AS description, 'carrer ' || o_orderkey AS address, 'not avl' AS email, 'not avl' AS website, 'barcelona' AS city,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_date, NULL::VARCHAR AS end_date,
        CASE WHEN o_orderkey % 3 <> 0 THEN 'POINT(2.1 41.4)' END AS "Point" FROM l)
    SELECT *, {FLAGS} FROM r
    """
)
def barcelona_events(spark: SparkSession, folder: str) -> DataFrame:
    """The first order priority is in the dictionary."""
    words = _priority_words(spark, folder, "museu ", "museum one", lower=True)
    return _texts(E.barcelona_events(E.barcelona_trusted(barcelona_feed(spark, folder)), words))


def madrid_feed(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        F.floor(k / 2).cast("string").alias("ID-EVENTO"),
        F.concat(F.lit("concierto  "), F.lpad(k.cast("string"), 12, "0"), F.lit(" !")).alias("TITULO"),
        F.concat(F.lit("Sala "), F.col("o_orderpriority")).alias("DESCRIPCION"),
        F.lit("L;x").alias("DIAS-SEMANA"),
        F.lit("28013").alias("CODIGO-POSTAL-INSTALACION"),
        F.when(k % 10 == 0, "nan").otherwise("40.5").alias("LATITUD"),
        F.lit("-3.25").alias("LONGITUD"),
        F.lit(" GRAN VIA ").alias("NOMBRE-VIA-INSTALACION"),
        F.when(k % 3 == 0, "none").otherwise("http://www.Madrid.es/a b").alias("CONTENT-URL"),
        F.col("o_orderdate").cast("string").alias("FECHA"),
        F.col("o_orderdate").cast("string").alias("FECHA-FIN"),
        F.lit("Madrid").alias("city"),
    )


@query(
    f"""
    WITH l AS (SELECT o_orderkey // 2 AS id, * FROM orders
               QUALIFY row_number() OVER (PARTITION BY o_orderkey // 2 ORDER BY o_orderkey) = 1),
    r AS (SELECT id, '¡Concierto ' || lpad(o_orderkey::VARCHAR, 12, '0') || '!' AS name,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'hall one' ELSE 'Sala ' || o_orderpriority END AS description,
        'gran via' AS address, 'not avl' AS email,
        NULL::VARCHAR AS website, 'madrid' AS city,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_date,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS end_date, 'POINT(-3.25 40.5)' AS "Point"
      FROM l WHERE o_orderkey % 10 <> 0)
    SELECT *, {FLAGS} FROM r
    """
)
def madrid_events(spark: SparkSession, folder: str) -> DataFrame:
    """The first order priority is in the dictionary."""
    words = _priority_words(spark, folder, "Sala ", "hall one")
    return _texts(E.madrid_events(E.madrid_trusted(madrid_feed(spark, folder)), words))


@query(
    f"""
    SELECT c_custkey::VARCHAR AS "ID", {sql.fold("c_name")} AS "Name", lpad(c_nationkey::VARCHAR, 5, '0') AS zip_code,
      'c/ major' AS address, round_even(c_acctbal, 0)::BIGINT AS x_coordinate, c_custkey AS y_coordinate,
      'Barcelona' AS city FROM customer WHERE c_custkey % 6 <> 0 AND c_custkey % 7 <> 0
    UNION ALL
    SELECT s_suppkey::VARCHAR, {sql.fold("s_name")}, '28001', 'calle', round_even(s_acctbal, 0)::BIGINT, 7, 'Madrid'
      FROM supplier
    UNION ALL
    SELECT p_partkey::VARCHAR, {sql.fold("p_name")}, '75001', 'rue', (p_size * 10000000)::BIGINT, 25000000, 'Paris'
      FROM part WHERE p_partkey % 9 <> 0
    """
)
def cultural_places(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    barcelona = table(spark, folder, "customer").select(
        k.alias("_id"), F.col("c_name").alias("name"),
        F.when(k % 6 == 0, "x8").otherwise(F.col("c_nationkey").cast("string")).alias("addresses_zip_code"),
        F.when(k % 7 > 0, "C/  Majór.").alias("addresses_road_name"),
        F.col("c_acctbal").alias("geo_epgs_25831_x"), k.cast("double").alias("geo_epgs_25831_y"),
    )
    madrid = table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("PK"), F.col("s_name").alias("NOMBRE"),
        F.lit("28001").alias("CODIGO-POSTAL"), F.lit("Calle").alias("NOMBRE-VIA"),
        F.col("s_acctbal").alias("COORDENADA-X"), F.lit(7.0).alias("COORDENADA-Y"),
    )
    paris = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("identifiant"), F.col("p_name").alias("nom_officiel"),
        F.lit("75001").alias("code_postal"), F.lit("RUE").alias("adresse"),
        F.when(F.col("p_partkey") % 9 == 0, "inconnu").otherwise(
            F.concat(F.col("p_size"), F.lit(".0, 2.5"))
        ).alias("coordonnees"),
    )
    return C.cultural_places(barcelona, [madrid], paris)


def hotel_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One document per customer with two hotels, in the landed shape."""
    k = F.col("c_custkey")

    def hotel(i: int):
        price = F.struct(F.lit("EUR").alias("currency"), F.col("c_acctbal").alias("value"))
        return F.struct(
            (k * 2 + i).alias("hotel_id"),
            F.struct(
                F.col("c_name").alias("name"),
                F.when(k % 5 > 0, k * 37 % 991 / 100.0 + i).alias("latitude"),
                (k * 53 % 997 / 100.0).alias("longitude"),
                F.array(F.concat(F.col("c_name"), F.lit(str(i))), F.col("c_mktsegment")).alias("photoUrls"),
                F.struct(F.lit("14:00").alias("fromTime")).alias("checkin"),
                F.struct(
                    price.alias("grossPrice"),
                    F.array(F.struct(F.lit("v").alias("variant"))).alias("benefitBadges"),
                ).alias("priceBreakdown"),
                (k % 2 == 0).alias("isPreferred"),
                F.lit("many").alias("reviewCount"),
            ).alias("property"),
        )

    return table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("city_code_name"),
        F.struct(F.array(hotel(0), hotel(1)).alias("hotels")).alias("data"),
    )


def address_book(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.concat_ws(" ", "p_name", "p_partkey").alias("address"), F.col("p_brand").alias("postcode"),
        (k * 41 % 89 / 8.0).alias("latitude"), (k * 23 % 97 / 8.0).alias("longitude"),
    )


@query(
    """
    WITH h AS (SELECT c_custkey * 2 + i AS hotel_id, c_name, c_acctbal, c_mktsegment, c_custkey, i,
                 CASE WHEN c_custkey % 5 > 0 THEN c_custkey * 37 % 991 / 100.0::DOUBLE + i END AS lat,
                 c_custkey * 53 % 997 / 100.0::DOUBLE AS lon
               FROM customer, (SELECT unnest([0, 1]) AS i)),
    p AS (SELECT p_name || ' ' || p_partkey AS a, p_brand AS z, p_partkey * 41 % 89 / 8.0::DOUBLE AS y,
            p_partkey * 23 % 97 / 8.0::DOUBLE AS x FROM part),
    n AS (SELECT hotel_id, min({'g': sqrt((x - lon) * (x - lon) + (y - lat) * (y - lat)), 'a': a, 'z': z}) AS m
          FROM h JOIN p ON sqrt((x - lon) * (x - lon) + (y - lat) * (y - lat)) <= 0.5 GROUP BY hotel_id)
    SELECT h.hotel_id::INT AS hotel_id, c_name AS property_name, lat AS property_latitude,
      c_acctbal AS property_priceBreakdown_grossPrice_value, '14:00' AS property_checkin_fromTime,
      c_custkey % 2 = 0 AS property_isPreferred, NULL::INT AS property_reviewCount,
      sha256(c_name || i) || ',' || sha256(c_mktsegment) AS property_photoHash,
      c_mktsegment AS city_code_name, m.a AS property_address, m.z AS property_postalcode
    FROM h LEFT JOIN n ON h.hotel_id = n.hotel_id
    """
)
def accommodation(spark: SparkSession, folder: str) -> DataFrame:
    trusted = A.accommodation_trusted(hotel_documents(spark, folder), ["city_code_name"])
    rows = A.accommodation(trusted, address_book(spark, folder), reach=0.5)
    return rows.select(
        "hotel_id", "property_name", "property_latitude", "property_priceBreakdown_grossPrice_value",
        "property_checkin_fromTime", "property_isPreferred", "property_reviewCount",
        F.array_join("property_photoHash", ",").alias("property_photoHash"), "city_code_name",
        "property_address", "property_postalcode",
    )


@query(
    """
    WITH h AS (SELECT o_orderkey, unnest(range(3)) AS i, o_totalprice, o_orderdate FROM orders)
    SELECT strftime(o_orderdate + to_hours(i::INT), '%Y-%m-%dT%H:%M') AS timestamp,
      lpad(i::VARCHAR, 2, '0') || ':00' AS time, o_totalprice AS temperature_2m, NULL::DOUBLE AS rain,
      o_orderkey::INT AS cloud_cover, 'rome' AS city_code_name FROM h
    """
)
def weather(spark: SparkSession, folder: str) -> DataFrame:
    stamps = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'"), F.lpad(i.cast("string"), 2, "0"), F.lit(":00")
        ),
    )
    documents = table(spark, folder, "orders").select(
        F.struct(
            stamps.alias("time"),
            F.array_repeat("o_totalprice", 4).alias("temperature_2m"),
            F.array_repeat("o_orderkey", 3).alias("cloud_cover"),
        ).alias("hourly")
    )
    return W.weather(W.weather_trusted(documents), "rome").select(
        "timestamp", "time", "temperature_2m", "rain", "cloud_cover", "city_code_name"
    )


@query(
    """
    WITH s AS (SELECT '28' || lpad(p_partkey::VARCHAR, 9, '0') AS z, p_partkey % 40 AS x, p_partkey // 40 AS y
               FROM part),
    f AS (SELECT DISTINCT c_custkey::VARCHAR AS id, c_name, c_mktsegment,
            '28' || lpad(c_custkey::VARCHAR, 9, '0') AS z FROM customer)
    SELECT 'zip' AS kind, z AS a, 'Madrid' AS b, NULL::DOUBLE AS d FROM s
    UNION ALL SELECT 'hotel', id, c_mktsegment, NULL FROM f
    UNION ALL SELECT 'route', l.z, r.z, round(sqrt(power(l.x - r.x, 2) + power(l.y - r.y, 2)), 9)
      FROM s l JOIN s r ON abs(l.x - r.x) <= 1 AND abs(l.y - r.y) <= 1 AND l.z <> r.z
    UNION ALL SELECT 'in', f.id, s.z, NULL FROM f JOIN s ON f.z = s.z
    """
)
def postal_graph(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    squares = table(spark, folder, "part").select(
        F.concat(F.lit("28"), F.lpad(k.cast("string"), 9, "0")).alias("COD_POSTAL"),
        _square(k % 40, F.floor(k / 40)).alias("ring"),
    )
    spain = P.spanish_cities(squares, ["Madrid"])
    hotels = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("property_id"), F.lit(1.0).alias("property_latitude"),
        F.lit(2.0).alias("property_longitude"), F.col("c_name").alias("property_name"),
        F.col("c_mktsegment").alias("city_code_name"),
        F.concat(F.lit("28"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("property_postalcode"),
    )
    graph = P.postal_graph({"Madrid": spain}, hotels)
    none = F.lit(None).cast("double").alias("d")
    parts = [
        graph["zip_nodes"].select(F.lit("zip").alias("kind"), F.col("ZIPCODE").alias("a"),
                                  F.col("CITY").alias("b"), none),
        graph["accommodation_nodes"].select(F.lit("hotel").alias("kind"), F.col("ID").alias("a"),
                                            F.col("CITY").alias("b"), none),
        graph["route_edges"].select(F.lit("route").alias("kind"), F.col("SRC").alias("a"),
                                    F.col("DST").alias("b"), F.round("Distance", 9).alias("d")),
        graph["located_in_edges"].select(F.lit("in").alias("kind"), F.col("ID").alias("a"),
                                         F.col("ZIPCODE").alias("b"), none),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(
    """
    WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x:
                 abs(x::DOUBLE) * 255.0::DOUBLE / 255.0::DOUBLE) AS v FROM embeddings),
    n AS (SELECT *, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b, 0.0::DOUBLE)) AS n
          FROM v)
    SELECT vec_id AS id, position, value FROM (
      SELECT vec_id, unnest(range(len(v))) AS position, unnest(list_transform(v, lambda x:
        CASE WHEN label < 2 THEN x::FLOAT::DOUBLE ELSE (x / n)::FLOAT::DOUBLE END)) AS value FROM n)
    """
)
def image_vectors(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "label",
        F.transform("embedding", lambda x: F.abs(x.cast("double")) * 255.0).alias("pixels"),
    )
    raw = F.transform("pixels", lambda x: (x / 255.0).cast("float")).alias("embedding")
    store = rows.where("label < 2").select("id", raw)
    table_rows = V.add_image_vectors(store, rows.drop("label"))
    return table_rows.select("id", F.posexplode("embedding").alias("position", "value")).select(
        "id", F.col("position").cast("bigint").alias("position"), F.col("value").cast("double").alias("value")
    )
