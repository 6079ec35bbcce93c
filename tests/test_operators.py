"""Operators on small hand-made fixtures."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from citylake.operators import dedupe as D
from citylake.operators import enrich as E
from citylake.operators import filters
from citylake.operators import graph as N
from citylake.operators import incremental as I
from citylake.operators import schema as S


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_schema_tokens():
    schema = S.schema_from_dict(
        {"a": "int", "b": "float", "c": "bool", "d": "odd", "e": ["int"], "f": [{"g": "str", "h": ["?"]}]}
    )
    assert schema.simpleString() == (
        "struct<a:int,b:double,c:boolean,d:string,e:array<int>,f:array<struct<g:string,h:array<string>>>>"
    )
    assert all(f.nullable for f in schema)


def test_flatten_orders_and_depth(spark):
    df = spark.sql(
        "SELECT named_struct('x', 1, 'y', named_struct('z', named_struct('u', named_struct('v', 2)))) AS p,"
        " array(named_struct('q', 1)) AS l, 3 AS `odd.name`"
    )
    assert S.flatten(df).columns == ["l", "odd.name", "p_x", "p_y"]
    deep = S.flatten(df, depth=3, in_order=True)
    assert deep.columns == ["p_x", "p_y_z_u", "l", "odd.name"]
    assert deep.first()["p_y_z_u"]["v"] == 2


def test_conform(spark):
    df = spark.createDataFrame([("x", 1.5, 1, 2**40)], "a string, b double, z int, wide long")
    schema = S.schema_from_dict({"a": "str", "b": "int", "c": "float", "wide": "int", "z": "str"})
    out = S.conform(df, schema)
    assert out.schema == schema
    assert out.first().asDict() == {"a": "x", "b": None, "c": None, "wide": None, "z": "1"}


def test_conform_equals_document_round_trip(spark):
    """Fields taken as they are give what a full re-read gives."""
    df = spark.sql(
        "SELECT * FROM VALUES (1L, 1.5D, 'a\"\\n', true, array('x', null), 5), "
        "(NULL, double('NaN'), NULL, NULL, NULL, NULL) AS t(l, d, s, b, arr, i)"
    )
    target = S.schema_from_dict(
        {"l": "int", "d": "float", "s": "str", "b": "bool", "arr": ["str"], "i": "float"}
    )
    whole = df.select(F.from_json(F.to_json(F.struct("*")), target).alias("r")).select("r.*")
    assert repr(S.conform(df, target).collect()) == repr(whole.collect())


def test_unpivot_stops_at_shortest(spark):
    df = spark.createDataFrame(
        [("rome", (["2024-07-05T00:00", "2024-07-05T01:00"], [0.0]))],
        "city string, hourly struct<time:array<string>,rain:array<double>>",
    )
    out = S.unpivot_hourly(df)
    assert out.columns == ["city", "timestamp", "time", "rain"]
    assert rows(out) == [("rome", "2024-07-05T00:00", "00:00", 0.0)]


def test_column_patterns(spark):
    df = spark.createDataFrame([("a", "b", 1)], "`Code X` string, other string, zip_CODE int")
    assert S.pick_columns(df, "code") == ["Code X", "zip_CODE"]
    assert S.pick_columns(df, "code", "string", exclude=["Code X"]) == []
    assert S.pick_columns(df, dtype="string", exclude="(code|x)") == ["other"]
    assert S.apply_to(df, F.upper, "code", "string").first() == ("A", "b", 1)


def test_open_validity_and_defaults(spark):
    df = S.open_validity(S.ensure_columns(spark.range(1), ["email"]))
    assert df.first() == (0, "not avl", dt.date(2025, 1, 1), dt.date(9999, 12, 31))


def test_position_flag(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, nan)], "lat double, lon double")
    flags = [r[0] for r in filters.with_position_flag(df, "lat", "lon", "f").select("f").collect()]
    assert flags == ["yes", "no", "no"]
    assert filters.has_position(df, "lat", "lon").count() == 1


def test_categories(spark):
    df = spark.createDataFrame([("Party", None), (None, None), ("x", "GYM park")], "name string, description string")
    got = [tuple(r)[2:] for r in filters.with_categories(df).collect()]
    assert got == [(0, 0, 1, 1), (0, 0, 0, 0), (1, 1, 0, 0)]


def test_in_list_or_keeps_each_row_once(spark):
    df = spark.createDataFrame([(1, "p"), (2, "q"), (3, None), (1, "q")], "k int, l string")
    ids = spark.createDataFrame([(1,), (1,)], "id int")
    out = filters.in_list_or(df, "k", ids, "id", F.col("l") == "p")
    assert rows(out) == [(1, "p"), (1, "q")]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, "10:00", "a"), (1, "11:00", "b"), (2, None, "c")], "id int, created string, v string"
    )
    assert rows(D.latest_per_key(df, "id", "created").select("id", "v")) == [(1, "b"), (2, "c")]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = D.latest_per_key(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Partial") < len(plan)


def test_dedupe_null_keys(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (None, "d")], "k int, v string")
    assert rows(D.dedupe(df, ["k"])) == [(1, "a"), (None, "c")]
    assert rows(D.dedupe(df, ["k"], null_keys="keep")) == [(1, "a"), (None, "c"), (None, "d")]


def test_postcodes_by_city(spark):
    df = spark.createDataFrame(
        [("Paris", "75001"), ("Paris", "75001"), ("Paris", "75002"), ("Paris", None), ("Rome", "00100")],
        "city_code_name string, property_postalcode string",
    )
    assert rows(D.postcodes_by_city(df)) == [
        ("Paris", 1, "75001"), ("Paris", 2, "75002"), ("Rome", 1, "00100"),
    ]


def test_bookkeeping_sets(spark):
    landing = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    trusted = spark.createDataFrame([("b",), ("b",)], "path string")
    assert rows(I.missing_in(landing, trusted)) == [("a",), ("c",)]
    target = spark.createDataFrame([("k1", "old")], "k string, v string")
    new = spark.createDataFrame([("k1", "new"), ("k2", "x"), ("k2", "y")], "k string, v string")
    assert rows(I.insert_if_absent(target, new, "k")) == [("k1", "old"), ("k2", "x")]
    inserted = I.new_rows(target, new, "k")
    assert inserted.join(target, "k").count() == 0


def test_work_list(spark):
    cities = spark.createDataFrame([("Rome",), ("Paris",), ("Madrid",), ("Barcelona",)], "city string")
    hotel = I.work_list(cities, "2025-07-05", "2025-07-06", "accommodation")
    assert hotel.count() == 8
    row = hotel.where("city = 'Rome'").orderBy("day").first()
    assert row.file_key == "accommodation/Rome/2025-07-05_2025-07-06.json"
    assert row.landing_path == "landing_zone/" + row.file_key
    weather = I.work_list(cities, "2025-07-05", "2025-07-06", "weather")
    assert {r.file_key for r in weather.where("city = 'Rome'").collect()} == {
        "weather/Rome/2024-07-05.json", "weather/Rome/2024-07-06.json",
    }


def test_ledger_append_skips_known_keys(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert I.ledger_read(spark, path).count() == 0
    keys = spark.createDataFrame([("a",), ("a",)], "file_key string")
    I.ledger_append(I.ledger_read(spark, path), keys).write.parquet(f"{path}/batch=0")
    logged = I.ledger_read(spark, path)
    assert [r.file_key for r in logged.collect()] == ["a"]
    assert I.ledger_append(logged, keys).count() == 0


@pytest.mark.parametrize(
    "repair, expected",
    [
        ((1, None, "08001"), (1, None, "08001")),
        ((1, None, None), (1, "A", None)),
        ((2, "B", "2"), (1, "A", None)),
    ],
)
def test_apply_addresses(spark, repair, expected):
    shape = "hotel_id int, property_address string, property_postalcode string"
    old = spark.createDataFrame([(1, "A", None)], shape)
    assert rows(E.apply_addresses(old, spark.createDataFrame([repair], shape))) == [expected]


def test_translate(spark):
    df = spark.createDataFrame([("ciao", 1), (" ", 2), (None, 3), ("x", 4)], "a string, n int")
    words = spark.createDataFrame([("ciao", "hello"), ("ciao", "hi"), (" ", "blank")], "source string, target string")
    assert rows(E.translate(df, ["a"], words).orderBy("n")) == rows(
        spark.createDataFrame([("hello", 1), (" ", 2), (None, 3), ("x", 4)], "a string, n int")
    )


def test_photo_pairs_by_position(spark):
    df = spark.createDataFrame([(1, ["u0", "u1"], ["h0"])], "id int, urls array<string>, hashes array<string>")
    assert rows(E.photo_pairs(df, "id", "urls", "hashes")) == [(1, 0, "h0", "u0")]
    assert [r.url for r in E.photo_pairs(df, "id", "urls").orderBy("position").collect()] == ["u0", "u1"]


def test_route_edges(spark):
    distances = spark.createDataFrame(
        [("08001", "08002", "1.5"), ("08001", "99999", "2"), ("08002", "08001", "x")],
        "COD_POSTAL_1 string, COD_POSTAL_2 string, distance string",
    )
    codes = spark.createDataFrame([("08001",), ("08002",)], "POSTAL_CODE string")
    zips = N.zip_nodes(codes, "Barcelona")
    assert rows(N.route_edges(distances, zips).select("SRC", "DST", "Distance")) == [
        ("08001", "08002", 1.5), ("08002", "08001", None),
    ]
    twice = zips.unionByName(zips)
    assert N.route_edges(distances, twice).count() == 8


def test_union_counts(spark):
    a, b = spark.range(5), spark.range(7)
    assert S.union_all([a, b, a]).count() == 17


def test_skewed_dedupe_matches_plain_code(spark):
    """One key holds most rows."""
    rng = random.Random(5)
    data = [(0 if rng.random() < 0.6 else rng.randrange(20), rng.randrange(1000), i) for i in range(5000)]
    df = spark.createDataFrame(data, "k int, v int, i int").repartition(8)
    expected = {}
    for k, v, i in data:
        if k not in expected or (v, i) > expected[k]:
            expected[k] = (v, i)
    got = {r.k: (r.v, r.i) for r in D.latest_per_key(df, "k", "v", ["i"]).collect()}
    assert got == expected
    assert not math.isnan(len(got))
