"""Vector operators over the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.catalog import query
from citylake.operators import vectors as V
from citylake.plans.image_vectors import image_vectors
from citylake.session import scratch, table
from citylake.sources import files


def _store(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


@query(
    """
    WITH q AS (SELECT label AS query_id, min(vec_id) AS v FROM embeddings GROUP BY label),
         d AS (SELECT query_id, e.vec_id AS id,
                 list_distance(e.embedding::DOUBLE[], o.embedding::DOUBLE[]) AS distance
               FROM q JOIN embeddings o ON o.vec_id = q.v CROSS JOIN embeddings e)
    SELECT query_id, id, round(distance, 6) AS distance,
      row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INT AS rank FROM d
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 10
    """
)
def l2_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten vectors nearest to each label's first vector."""
    store = _store(spark, folder)
    queries = store.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "id").alias("query"))
    found = V.l2_topk(store, queries, 10)
    return found.withColumn("distance", F.round("distance", 6))


@query(
    """
    SELECT vec_id AS id, label FROM embeddings WHERE label = 2 ORDER BY vec_id LIMIT 100
    """
)
def query_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return V.query_vectors(_store(spark, folder), "label = 2", ["id", "label"])


@query(
    """
    SELECT vec_id::VARCHAR AS id, 'dimension' AS problem FROM embeddings WHERE label = 3
    UNION ALL SELECT repeat('x', 101) || vec_id, 'long id' FROM embeddings WHERE label = 2
    UNION ALL SELECT label::VARCHAR || '!', 'duplicate id' FROM embeddings WHERE label = 1
      GROUP BY label HAVING count(*) > 1
    """
)
def validate_vectors(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("label")
    key = F.col("id").cast("string")
    rows = _store(spark, folder).select(
        F.when(label == 1, F.concat(label, F.lit("!")))
        .when(label == 2, F.concat(F.repeat(F.lit("x"), 101), key))
        .otherwise(key)
        .alias("id"),
        F.when(label == 3, F.slice("embedding", 1, 5)).otherwise(F.col("embedding")).alias("embedding"),
    )
    return V.validate_vectors(rows, dim=64)


@query("SELECT vec_id AS id, CASE WHEN label < 3 THEN 0 ELSE 1 END AS added FROM embeddings")
def insert_vectors(spark: SparkSession, folder: str) -> DataFrame:
    rows = _store(spark, folder)
    stored = rows.where("label < 3").select("id", "embedding", F.lit(0).alias("added"))
    return V.insert_vectors(stored, rows.select("id", "embedding", F.lit(1).alias("added"))).select(
        "id", "added"
    )


def _land_images(spark: SparkSession, folder: str) -> str:
    """Embeddings as one byte a pixel, each in a file; every fifth also in a second city, all of its pixels 0."""
    root = scratch(spark, "images")
    pixels = F.transform("embedding", lambda v: F.pmod(F.floor(v.cast("double") * 100), F.lit(256)))
    content = lambda values: F.unhex(F.array_join(F.transform(values, lambda p: F.lpad(F.hex(p), 2, "0")), ""))
    rows = table(spark, folder, "embeddings").select("vec_id", pixels.alias("p"))
    black = F.transform("p", lambda v: v * 0)
    rome = rows.select(F.concat(F.lit("rome/v"), "vec_id", F.lit(".jpg")).alias("name"), content(F.col("p")).alias("content"))
    zero = rows.where("vec_id % 5 = 0").select(
        F.concat(F.lit("venice/v"), "vec_id", F.lit(".png")).alias("name"), content(black).alias("content")
    )
    files.write_contents(rome.union(zero), root).agg(F.sum("length")).collect()
    return root


@query(
    """
    SELECT 'v' || vec_id AS id, len(embedding)::INT AS n_bytes,
      upper(array_to_string(list_transform(embedding, lambda v:
        lpad(lower(to_hex((((floor(v::DOUBLE * 100)::BIGINT % 256) + 256) % 256)::BIGINT)), 2, '0')), '')) AS content
    FROM embeddings
    """
)
def image_assets(spark: SparkSession, folder: str) -> DataFrame:
    """Files listed by name; of two with one stem the first path is opened, the other never."""
    assets = files.assets_table(spark, _land_images(spark, folder))
    return assets.select(
        "id", F.length("image_bytes").cast("int").alias("n_bytes"), F.hex("image_bytes").alias("content")
    )


@query(
    """
    WITH p AS (SELECT vec_id, label, list_transform(embedding, lambda v:
             ((((floor(v::DOUBLE * 100)::BIGINT % 256) + 256) % 256) / 255.0)::DOUBLE) AS x FROM embeddings),
         n AS (SELECT vec_id, label, x, sqrt(list_inner_product(x, x)) AS norm FROM p),
         u AS (SELECT vec_id, label, CASE WHEN vec_id % 3 = 0 THEN list_transform(x, lambda v: CAST(0 AS DOUBLE))
             WHEN norm > 0 THEN list_transform(x, lambda v: CAST(CAST(v / norm AS FLOAT) AS DOUBLE)) ELSE x END AS v FROM n),
         q AS (SELECT label AS query_id, min(vec_id) AS first FROM u WHERE vec_id % 3 <> 0 GROUP BY label),
         d AS (SELECT query_id, 'v' || u.vec_id AS id, list_distance(u.v, o.v) AS distance
               FROM q JOIN u o ON o.vec_id = q.first CROSS JOIN u)
    SELECT query_id, id, round(distance, 6) AS distance,
      row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INT AS rank FROM d
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 10
    """
)
def image_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Files to assets, pixels and unit vectors; contract, insert of those absent, then the nearest of each label's first."""
    labels = table(spark, folder, "embeddings").select(F.concat(F.lit("v"), "vec_id").alias("id"), "vec_id", "label")
    assets = files.assets_table(spark, _land_images(spark, folder))
    digits = F.hex("image_bytes")
    pixels = F.transform(
        F.sequence(F.lit(1), 2 * F.length("image_bytes") - 1, F.lit(2)),
        lambda at: F.conv(F.substring(digits, at, F.lit(2)), 16, 10).cast("int"),
    )
    # Every third vector is stored before, as zeros.
    stored = labels.where("vec_id % 3 = 0").select("id", F.array_repeat(F.lit(0.0), 64).alias("embedding"))
    new = image_vectors(assets.where("length(image_bytes) > 0").select("id", pixels.alias("pixels")))
    breaches = V.validate_vectors(new, dim=64).select("id").distinct()
    store = V.insert_vectors(stored, new.join(breaches, "id", "left_anti"))
    first = labels.where("vec_id % 3 <> 0").groupBy(F.col("label").alias("query_id")).agg(F.min_by("id", "vec_id").alias("id"))
    asked = store.join(first, "id").select("query_id", F.col("embedding").alias("query"))
    found = V.l2_topk(store, asked, 10).withColumn("distance", F.round("distance", 6))
    return found.select("query_id", "id", "distance", "rank")
