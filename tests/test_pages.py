"""Pages in the order of their links, and sinks that run their plan once."""

from pyspark.sql import functions as F

from citylake.operators.pages import in_link_order, missing_pages
from citylake.sources import files


def test_link_order(spark):
    rows = [(f"p{i}", f"p{i + 1}", i) for i in range(37) if i != 20]
    rows += [("p5", "p6", 500), ("ring a", "ring b", 0), ("ring b", "ring a", 1), (None, "p0", 9), ("alone", None, 3), ("self", "self", 4)]
    df = spark.createDataFrame(rows, "`the link` string, following string, n int").repartition(4)
    got = {(r["the link"], r.n): (r.page_no, r.chain) for r in in_link_order(df, "the link", "following").collect()}
    assert len(got) == len(rows)
    for i in range(37):
        if i != 20:
            assert got[(f"p{i}", i)] == ((i, "p0") if i < 20 else (i - 21, "p21"))
    assert got[("p5", 500)] == (5, "p0") and got[("alone", 3)] == (0, "alone")
    assert got[("ring a", 0)] == got[("ring b", 1)] == got[("self", 4)] == got[(None, 9)] == (None, None)
    missing = {(r.page, r.linked_from) for r in missing_pages(df, "the link", "following").collect()}
    assert missing == {("p20", "p19"), ("p37", "p36")}
    assert in_link_order(df.where("false"), "the link", "following").count() == 0


def _counted(spark, df):
    """``df`` and an accumulator of the rows that its plan computes."""
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for batch in parts:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_sinks_run_their_plan_once(spark, tmp_path):
    rows = spark.range(1000).withColumn("part", F.col("id") % 3)
    for partition_by in (None, "part"):
        path = str(tmp_path / f"t{partition_by}")
        df, seen = _counted(spark, rows)
        assert files.write_trusted(df, path, partition_by) and seen.value == 1000
        assert spark.read.parquet(path).count() == 1000
        # A table may be replaced by what is read from it.
        assert files.write_trusted(spark.read.parquet(path).where("id < 10"), path, partition_by)
        empty, seen = _counted(spark, rows.where("id < 0"))
        assert not files.replace_if_nonempty(empty, path=path)
        assert spark.read.parquet(path).count() == 10
    assert sorted(p.name for p in tmp_path.iterdir()) == ["tNone", "tpart"]


def test_files_of_two_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id;name\n1;Muñoz\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("name;id\nNiño;2\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes(b"")
    found = {k: [f.rsplit("/", 1)[1] for f in v] for k, v in files.encodings(spark, str(tmp_path)).items()}
    assert found["ISO-8859-1"] == ["b.csv"] and "a.csv" in found["UTF-8"]
    rows = files.scan_sources(spark, {"x": str(tmp_path)})["x"].collect()
    assert {(r.id, r.name, r.city) for r in rows} == {("1", "Muñoz", "x"), ("2", "Niño", "x")}
