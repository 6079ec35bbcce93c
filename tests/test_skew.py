"""A key that holds most rows is split, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from citylake.operators import enrich, filters, geo, graph, incremental, shapes
from citylake.operators.joins import lookup

# AQE at a scale where a test table counts as large.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


@pytest.fixture
def small_scale(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark, n=40_000):
    """Two thirds of the rows share one key; every row is distinct."""
    key = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, n, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def plan_after(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def names(df):
    return df.select("k").distinct().where("k != 'k7'")


def test_anti_join_is_split(small_scale):
    df = hot(small_scale)
    out = incremental.pending(
        df.withColumnRenamed("k", "file_key"),
        names(df).where("k != 'hot'").withColumnRenamed("k", "file_key"),
    )
    assert "skew=true" in plan_after(out)
    assert out.where("file_key = 'hot'").count() == df.where("k = 'hot'").count()


def test_semi_join_is_split(small_scale):
    df = hot(small_scale)
    out = filters.in_list_or(df, "k", names(df), "k", F.col("id") < 0)
    assert "skew=true" in plan_after(out)
    assert out.count() == df.where("k != 'k7'").count()


def test_translation_is_split(small_scale):
    df = hot(small_scale)
    words = names(df).select(F.col("k").alias("source"), F.upper("k").alias("target"))
    out = enrich.translate(df, ["k"], words)
    assert "skew=true" in plan_after(out)
    assert out.where("k = 'HOT'").count() == df.where("k = 'hot'").count() and out.count() == df.count()


def test_edges_are_split(small_scale):
    df = hot(small_scale)
    zips = graph.zip_nodes(df.select(F.col("k").alias("POSTAL_CODE")).distinct(), "X")
    distances = df.select(F.col("k").alias("COD_POSTAL_1"), F.col("k").alias("COD_POSTAL_2"), F.xxhash64("id").cast("string").alias("distance"))
    out = graph.route_edges(distances, zips)
    assert "skew=true" in plan_after(out)
    assert out.count() == df.count()


def test_positions_are_split(small_scale):
    df = hot(small_scale).select(
        "id", "pad", F.when(F.col("k") == "hot", 1.0).otherwise(F.col("id") % 100 / 10.0).alias("property_latitude"),
        F.lit(-0.0).alias("property_longitude"),
    )
    places = small_scale.range(100).select(
        F.col("id").cast("string").alias("address"), F.lit("z").alias("postcode"),
        (F.col("id") / 10.0).alias("latitude"), F.lit(0.0).alias("longitude"),
    )
    out = geo.reverse_geocode(df, places, reach=0.05)
    assert "skew=true" in plan_after(out)
    assert out.where("property_address = '10'").count() == df.where("property_latitude = 1.0").count()
    assert out.where("property_address IS NULL").count() == 0 and out.count() == df.count()


def test_lookup_mixed_types(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (3,)], "b bigint")
    assert [r.a for r in lookup(left, right, {"b": F.col("a")}, "left_semi").collect()] == [1]
    assert lookup(left, right, {"b": F.col("a")}, "left").count() == 3
    zero = spark.createDataFrame([(0.0,)], "x double")
    minus = spark.createDataFrame([(-0.0,)], "y double")
    assert lookup(zero, minus, {"y": F.col("x")}, "inner").count() == 1


def test_translate_by_a_small_dictionary_shuffles_no_rows(spark):
    """Rows of few values stay where they are read; a shuffle would send each value to one task."""
    df = hot(spark).withColumn("k", F.when(F.col("id") % 3 < 2, "hot").otherwise(" "))
    words = spark.createDataFrame([("hot", "warm"), ("hot", "warm"), ("cold", None)], "source string, target string")
    out = enrich.translate(df, ["k"], words)
    assert "hashpartitioning(_left_hash" not in plan_after(out)
    assert {tuple(r) for r in out.groupBy("k").count().collect()} == {("warm", 26_667), (" ", 13_333)}


def test_met_edges_are_narrow(spark, monkeypatch):
    """What is written for each pair of edges holds numbers of shapes and ends only."""
    seen = {}
    write = shapes.materialise
    monkeypatch.setattr(shapes, "materialise", lambda df, label: seen.setdefault(label, write(df, label)))
    ring = lambda x, y: F.array(*[F.struct((x + dx).cast("double").alias("x"), (y + dy).cast("double").alias("y")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    k = F.col("id")
    df = spark.range(400).select(k.cast("string").alias("COD_POSTAL"), ring(k % 20, F.floor(k / 20)).alias("ring"))
    pairs = {tuple(r) for r in geo.touching_pairs(df).collect()}
    near = lambda a, b: abs(a % 20 - b % 20) <= 1 and abs(a // 20 - b // 20) <= 1 and a != b
    assert pairs == {(str(a), str(b)) for a in range(400) for b in range(400) if near(a, b)}
    types = dict(seen["meeting"].dtypes)
    assert types["l_owner"] == types["r_owner"] == "bigint"
    assert sum(t == "double" for t in types.values()) == 8
    assert seen["open"].isEmpty()
