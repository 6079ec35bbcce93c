"""Scans, sinks and incremental runs on small files."""

import json

import pytest
from pyspark.sql import functions as F

from citylake.functions.text import sha256
from citylake.operators.incremental import ledger_read
from citylake.plans import weather as W
from citylake.sources import files, jdbc
from citylake.streaming.sync import sync_exploitation, sync_trusted


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
    return str(path)


@pytest.mark.parametrize(
    "header, expected",
    [("a;b;c", ";"), ("a,b", ","), ("a|b", "|"), ("a\tb", "\t"), ('"x;y;z",b,c', ","), ("alone", ",")],
)
def test_sniffing(header, expected):
    assert files.sniff_delimiter(header) == expected


def test_scan_csv_skips_long_rows_only(spark, tmp_path):
    path = put(tmp_path / "a.csv", '﻿id;"the name"\n1;x\n2;y;surplus\n3\n4;"two\nlines; quoted ""q"""\n')
    df = files.scan_csv(spark, path, multiline=True)
    assert df.columns == ["id", "the name"]
    assert rows(df) == [("1", "x"), ("3", None), ("4", 'two\nlines; quoted "q"')]
    assert df.count() == 3


def test_scan_csv_encoding(spark, tmp_path):
    path = put(tmp_path / "l.csv", "nom;x\nété;1\n".encode("latin-1"))
    assert rows(files.scan_csv(spark, path, encoding="ISO-8859-1")) == [("été", "1")]


def test_repaired_text_and_lines(spark, tmp_path):
    put(tmp_path / "t" / "a.txt", "né".encode("latin-1"))
    put(tmp_path / "t" / "b.txt", "né")
    assert [r.text for r in files.scan_text_repaired(spark, str(tmp_path / "t")).collect()] == ["né", "né"]
    path = put(tmp_path / "lines.txt", 'a "b" &amp; c\nESPA&Ntilde;A é\n'.encode("latin-1"))
    assert rows(files.scan_clean_lines(spark, path)) == [("ESPAñA é",), ("a b & c",)]
    path = put(tmp_path / "blank.txt", "a\n\n \nb\n")
    assert [len(r.line.strip()) for r in files.scan_clean_lines(spark, path).collect()] == [1, 0, 0, 1]


def test_scan_csv_by_header(spark, tmp_path):
    put(tmp_path / "two" / "a.csv", "id;name\n1;x\n")
    put(tmp_path / "two" / "b.csv", "name;id\ny;2\n")
    got = files.scan_csv(spark, str(tmp_path / "two")).select("id", "name")
    assert rows(got) == [("1", "x"), ("2", "y")]


def test_scan_sources_falls_back(spark, tmp_path):
    good = put(tmp_path / "rome.csv", "id,name\n1,a\n")
    frames = files.scan_sources(spark, {"rome": good, "paris": str(tmp_path / "missing.csv")})
    assert rows(frames["rome"]) == [("1", "a", "rome")]
    assert frames["paris"].columns == ["id", "name", "city"] and frames["paris"].isEmpty()


def test_empty_frames_are_not_written(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    assert files.write_trusted(df, path) and not files.write_trusted(df.where("id < 0"), path)
    assert spark.read.parquet(path).count() == 3


def test_result_table_survives_an_empty_result(spark):
    df = spark.range(3)
    assert files.replace_if_nonempty(df, "kept_filtered")
    assert not files.replace_if_nonempty(df.where("id > 9"), "kept_filtered")
    assert spark.table("kept_filtered").count() == 3
    assert files.replace_if_nonempty(df.where("id = 1"), "kept_filtered")
    assert spark.table("kept_filtered").count() == 1


def test_csv_sink(spark, tmp_path):
    files.write_csv(spark.createDataFrame([("a", "x,y")], "k string, v string"), str(tmp_path / "o"))
    assert rows(files.scan_csv(spark, str(tmp_path / "o"))) == [("a", "x,y")]


def test_lake_listing_and_assets(spark, tmp_path):
    root = tmp_path / "trusted_zone"
    put(root / "accommodation_images" / "Rome" / "h1.jpg", b"\x01")
    put(root / "accommodation_images" / "Paris" / "h1.jpg", b"\x01")
    put(root / "accommodation_images" / "Paris" / "h2.v2.jpg", b"\x02")
    put(root / "weather" / "Rome" / "2024-07-05.json", "{}")
    listed = files.list_zone(spark, str(root), "accommodation_images").select("city", "file_name")
    assert rows(listed) == [("Paris", "h1.jpg"), ("Paris", "h2.v2.jpg"), ("Rome", "h1.jpg")]
    assets = files.assets_table(spark, str(root / "accommodation_images"))
    assert [(r.id, bytes(r.image_bytes)) for r in assets.orderBy("id").collect()] == [
        ("h1", b"\x01"), ("h2.v2", b"\x02"),
    ]
    stored = spark.createDataFrame([("h1", bytearray(b"old"))], "id string, image_bytes binary")
    merged = files.assets_table(spark, str(root / "accommodation_images"), stored)
    assert {r.id: bytes(r.image_bytes) for r in merged.collect()} == {"h1": b"old", "h2.v2": b"\x02"}
    assert spark.range(1).select(sha256(F.lit("u"))).first()[0]


def test_only_winners_are_opened(spark, tmp_path):
    """The scan lists names without contents, and a file that loses is never opened."""
    put(tmp_path / "Paris" / "a b%20ü.jpg", b"first")
    put(tmp_path / "Rome" / "a b%20ü.png", b"second")
    put(tmp_path / "Rome" / "empty.png", b"")
    assets = files.assets_table(spark, str(tmp_path))
    scan = assets._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in scan and "image_bytes" in scan
    (tmp_path / "Rome" / "a b%20ü.png").unlink()
    (tmp_path / "Rome" / "a b%20ü.png").mkdir()  # to open it would fail
    assert rows(assets.select("id", F.decode("image_bytes", "UTF-8"))) == [("a b%20ü", "first")]


def test_written_contents(spark, tmp_path):
    df = spark.createDataFrame([("x/1.bin", bytearray(b"12")), ("2.bin", None)], "name string, content binary")
    done = rows(files.write_contents(df, str(tmp_path)))
    assert [length for _, length in done] == [0, 2] and (tmp_path / "x" / "1.bin").read_bytes() == b"12"
    asked = spark.createDataFrame([(done[1][0], 1), (None, 2)], "path string, n int")
    assert {r.n: r.content and bytes(r.content) for r in files.fetch_contents(asked).collect()} == {1: b"12", 2: None}


def hour_document(n):
    return json.dumps({"hourly": {"time": [f"2024-07-05T{h:02}:00" for h in range(n)], "rain": [0.5] * n}})


def test_sync_trusted_processes_each_file_once(spark, tmp_path):
    src, dst, ckpt = (str(tmp_path / p) for p in ("landing_zone/weather", "trusted", "ckpt"))

    def run():
        sync_trusted(spark, src, dst, ckpt, W.RAW_SCHEMA, lambda df: W.weather_trusted(df, ["city"]))
        return spark.read.parquet(dst).count()

    put(tmp_path / "landing_zone" / "weather" / "Rome" / "2024-07-05.json", hour_document(2))
    assert run() == 2
    put(tmp_path / "landing_zone" / "weather" / "Paris" / "2024-07-05.json", hour_document(3))
    assert run() == 5
    assert run() == 5
    assert {r.city for r in spark.read.parquet(dst).select("city").distinct().collect()} == {"Rome", "Paris"}


def test_sync_exploitation_uses_the_ledger(spark, tmp_path):
    src, dst, ledger = (str(tmp_path / p) for p in ("trusted_zone/weather", "expl", "ledger"))

    def run(checkpoint):
        sync_exploitation(
            spark, "weather", src, dst, ledger, str(tmp_path / checkpoint), "a int",
            lambda df: df.select("a", "city"), "json",
        )
        return spark.read.parquet(dst).count()

    put(tmp_path / "trusted_zone" / "weather" / "Rome" / "d1.json", '{"a": 1}')
    assert run("c1") == 1
    put(tmp_path / "trusted_zone" / "weather" / "Rome" / "d2.json", '{"a": 2}')
    assert run("c1") == 2
    assert run("c1") == 2
    keys = sorted(r.file_key for r in ledger_read(spark, ledger).collect())
    assert keys == ["weather/Rome/d1.json", "weather/Rome/d2.json"]


def test_jdbc_options(spark, monkeypatch):
    """What is handed to Spark's source; no database is started for the tests."""
    seen = []

    class Writer:
        def format(self, name):
            seen.append(name)
            return self

        def options(self, **options):
            seen.append(options)
            return self

        def mode(self, mode):
            seen.append(mode)
            return self

        def save(self):
            seen.append("saved")

    class Frame:
        write = Writer()

    jdbc.write_jdbc(Frame(), "jdbc:x", "t", driver="d")
    assert seen[0] == "jdbc" and seen[2:] == ["append", "saved"]
    assert seen[1]["url"] == "jdbc:x" and seen[1]["dbtable"] == "t" and seen[1]["driver"] == "d"
    seen.clear()
    jdbc.write_jdbc_all({"a": Frame(), "b": Frame()}, "jdbc:x")
    assert [s for s in seen if s in ("overwrite", "append")] == ["overwrite"] * 2
