"""Vector operators against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from citylake.operators import vectors as V
from citylake.plans.image_vectors import add_image_vectors


@pytest.mark.parametrize("block_bytes", [V.BLOCK_BYTES, 300])
def test_topk_is_exact(spark, block_bytes):
    """Small blocks force several passes; the result is the same."""
    rng = np.random.default_rng(3)
    data = rng.integers(0, 4, size=(300, 5)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, embedding array<float>")
    asked = rng.integers(0, 4, size=(20, 5)).astype(float)
    queries = spark.createDataFrame(
        [(f"q{i}", v.tolist()) for i, v in enumerate(asked)], "query_id string, query array<float>"
    )
    got = V.l2_topk(df.repartition(4), queries, 4, block_bytes=block_bytes)
    found = {(r.query_id, r["rank"]): (r.id, r.distance) for r in got.collect()}
    assert len(found) == 80
    for i, q in enumerate(asked):
        gaps = np.sqrt(((data - q) ** 2).sum(axis=1))
        order = sorted(range(len(data)), key=lambda j: (gaps[j], j))[:4]
        assert [found[(f"q{i}", r + 1)] for r in range(4)] == [(j, pytest.approx(gaps[j])) for j in order]


def test_topk_by_width(spark):
    """A stray query of another width is answered by rows of its width and disturbs no other."""
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], "id long, embedding array<float>")
    queries = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [1.0, 1.0, 1.0])], "query_id string, query array<float>")
    got = sorted((r.query_id, r.id, r.distance) for r in V.l2_topk(df, queries, 2).collect())
    assert got == [("a", 1, 0.0), ("a", 2, 5.0)]


def test_topk_without_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "id long, embedding array<float>")
    queries = spark.createDataFrame([], "query_id string, query array<float>")
    assert V.l2_topk(df, queries, 3).count() == 0


def test_contract(spark):
    df = spark.createDataFrame(
        [("a", [1.0]), ("a", [1.0]), ("b" * 101, [1.0]), ("c", [1.0, 2.0]), (None, None)],
        "id string, embedding array<float>",
    )
    got = sorted((r.id or "", r.problem) for r in V.validate_vectors(df, 1).collect())
    assert got == [
        ("", "dimension"), ("", "null id"), ("a", "duplicate id"), ("b" * 101, "long id"), ("c", "dimension"),
    ]


def test_query_defaults(spark):
    df = spark.range(150).select("id", F.array(F.lit(1.0)).alias("embedding"), F.lit(1).alias("x"))
    out = V.query_vectors(df)
    assert out.columns == ["id", "embedding"] and out.count() == 100
    assert V.query_vectors(df, "id >= 149").first().id == 149


def test_only_new_images_are_added(spark):
    store = spark.createDataFrame([("a", [9.0])], "id string, embedding array<float>")
    pixels = spark.createDataFrame([("a", [255]), ("b", [0]), ("b", [0])], "id string, pixels array<int>")
    got = {r.id: r.embedding for r in add_image_vectors(store, pixels).collect()}
    assert got == {"a": [9.0], "b": [0.0]}


def _brute(data, asked, k):
    out = set()
    for i, q in enumerate(asked):
        gaps = np.sqrt(((data - q) ** 2).sum(axis=1))
        order = sorted(range(len(data)), key=lambda j: (gaps[j], j))[:k]
        out |= {(i, rank + 1, j, round(float(gaps[j]), 9)) for rank, j in enumerate(order)}
    return out


@pytest.mark.parametrize("block_bytes", [100_000, 4000])
def test_topk_prunes_by_pivots(spark, block_bytes):
    """Clustered rows, a third of them copies of one: equal to brute force with few rows compared."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 8)) * 50
    data = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 8))
    data[::3] = data[0]
    asked = np.concatenate([data[1:40:2], rng.normal(size=(5, 8)) * 50])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id int, query array<double>")
    compared = spark.sparkContext.accumulator(0)
    got = V.l2_topk(df, queries, 7, block_bytes=block_bytes, compared=compared).collect()
    assert {(r.query_id, r["rank"], r.id, round(r.distance, 9)) for r in got} == _brute(data, asked, 7)
    assert compared.value < 0.2 * len(data) * len(asked)


def test_topk_edges(spark):
    """Null and empty vectors, values that are no number, fewer rows than asked for, few pivots of many widths."""
    nan = float("nan")
    rows = [(1, [0.0, 0.0]), (2, [nan, 1.0]), (3, None), (4, []), (5, [3.0, 4.0]), (6, [1.0]), (7, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    queries = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [2.0]), ("c", None)], "query_id string, query array<double>")
    for pivot_bytes, block_bytes in ((V.PIVOT_BYTES, 1), (8, 1), (8, V.BLOCK_BYTES)):
        got = V.l2_topk(df, queries, 2, pivot_bytes=pivot_bytes, block_bytes=block_bytes).collect()
        assert sorted((r.query_id, r["rank"], r.id) for r in got) == [("a", 1, 1), ("a", 2, 5), ("b", 1, 6)]
    got = V.l2_topk(df, queries, 5, block_bytes=1).where("query_id = 'a'").collect()
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == [1, 5, 2]


def test_topk_of_no_rows(spark):
    df = spark.createDataFrame([], "id long, embedding array<double>")
    queries = spark.createDataFrame([("a", [0.0])], "query_id string, query array<double>")
    assert V.l2_topk(df, queries, 2).count() == 0
