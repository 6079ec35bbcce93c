"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citylake.llm import (
    decontaminate, line_dedup, minhash_dedup, packing, paragraph_dedup, quality_net, quality_rules, secret_crf,
    sequence_files, toxicity,
)
from citylake.llm.storage import fresh

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CLASHING = [
    "node", "key", "component", "h", "label", "row_key", "words", "kept", "_key", "_left_hash", "rest", "payload",
    "line_no", "found_id", "kept_id", "quality", "votes", "n_words",
]
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
LINE = "one two three four five six seven eight nine ten"
PROSE = (
    "The old bridge at the end of the valley was built in stone by people of the nearby town. It stands on three "
    "arches, and a narrow path leads from it to the mill. In spring the river rises to the second row of blocks, but "
    "no flood has ever moved them. Visitors come for the view in the evening, when light falls on the water and "
    "swallows hunt above. A small museum on the left bank shows tools, maps and letters of the masons."
)


def odd(spark, empty=False):
    rows = [
        (None, None), (None, LINE), (1, None), (2, ""), (3, " \n\t\n"), (4, "word"), (5, LINE), (5, LINE), (6, LINE),
        (7, LONG), (8, LONG + " tail"), (9, PROSE), (10, "\n".join([LINE, "", LINE])), (11, "é ü ñ 漢字 🙂"),
        (12, 'token = "abcdef1234567890abcdef"'), (12, "another text under the same id"),
    ]
    df = spark.createDataFrame([] if empty else rows, "doc_id long, text string").repartition(3)
    return df.select("doc_id", "text", *[F.lit("x").alias(c) for c in CLASHING])


def benchmark(spark, empty=False):
    rows = [(1, LINE), (2, None), (3, ""), (None, " ".join(LONG.split()[100:140])), (5, "word")]
    return spark.createDataFrame([] if empty else rows, "item_id long, text string")


def scored(spark, docs, module, column):
    labels = docs.select("text", F.coalesce(F.col("doc_id") % 2, F.lit(0)).cast("int").alias("label"))
    if module is toxicity:
        return toxicity.score(docs, toxicity.fit(labels))
    vectors = quality_net.word_vectors(docs)
    return quality_net.score(docs, vectors, quality_net.fit(labels, vectors))


OPERATORS = {
    "op1": lambda s, d: quality_rules.annotate(d),
    "op2": lambda s, d: minhash_dedup.near_duplicates(d, size=2),
    "op3": lambda s, d: scored(s, d, toxicity, "toxic"),
    "op6": lambda s, d: _sequences(s, d),
    "op7": lambda s, d: scored(s, d, quality_net, "quality"),
    "op8": lambda s, d: secret_crf.secrets(d),
}


def _sequences(spark, docs):
    path = fresh(spark, "sequences")
    sequence_files.write_sequences(docs, path, TOKENIZER, end=2)
    return sequence_files.read_documents(spark, path)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, name):
    docs = odd(spark)
    got = OPERATORS[name](spark, docs).select("doc_id").collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0)
    assert sorted(got, key=key) == sorted(docs.select("doc_id").collect(), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, odd(spark, empty=True)).count() == 0


def test_repeated_passages(spark):
    found = paragraph_dedup.repeated_passages(odd(spark)).collect()
    assert {r.doc_id for r in found} == {7, 8} and {r.kept for r in found} == {True, False}
    assert paragraph_dedup.repeated_passages(odd(spark, empty=True)).count() == 0


def test_lines(spark):
    found = line_dedup.line_groups(odd(spark)).collect()
    shorter = [r for r in found if r.group_size == 5]
    # Null, 5 (its equal rows are one document), 6, and two lines of 10; the null id comes first.
    assert len(shorter) == 5 and [r.doc_id for r in shorter if r.kept] == [None]
    kept = line_dedup.remove_lines(odd(spark))
    assert kept.columns == odd(spark).columns
    texts = {r.doc_id: r.text for r in kept.where("doc_id IS NOT NULL").collect()}
    assert not {5, 6, 8, 10} & set(texts)
    assert {1, 2, 3, 4, 7, 9, 11} <= set(texts)
    assert line_dedup.remove_lines(odd(spark, empty=True)).count() == 0


def test_deduplicate(spark):
    kept = minhash_dedup.deduplicate(odd(spark), size=5)
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert ids == [1, 2, 3, 4, 5, 5, 7, 9, 10, 11, 12, 12]
    assert kept.columns == odd(spark).columns
    assert minhash_dedup.deduplicate(odd(spark, empty=True)).count() == 0


def test_decontaminate(spark):
    found = decontaminate.contaminated(odd(spark), benchmark(spark))
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == {(None, 1), (5, 1), (6, 1), (10, 1), (7, None), (8, None), (4, 5)}
    left = decontaminate.decontaminate(odd(spark), benchmark(spark))
    assert sorted(r.doc_id for r in left.where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 9, 11, 12, 12]
    for docs, items in ((True, False), (False, True)):
        assert decontaminate.contaminated(odd(spark, docs), benchmark(spark, items)).count() == 0


def test_pack(spark):
    rows = packing.pack(odd(spark), TOKENIZER, end=0).collect()
    assert sum(r.piece == 0 for r in rows) == odd(spark).count()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack(odd(spark, empty=True), TOKENIZER, end=0).count() == 0


def test_keep_good(spark):
    kept = quality_rules.keep_good(odd(spark), fresh(spark, "quality"))
    assert kept.columns == odd(spark).columns and {r.doc_id for r in kept.collect()} >= {9}


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline(spark, tmp_path, empty):
    odd(spark, empty).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert ({r.doc_id for r in rows} >= {9}) if not empty else rows == []
