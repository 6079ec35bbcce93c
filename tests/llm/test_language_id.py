"""Language identification: scores and paths against plain loops, mixed texts, scripts and odd inputs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from citylake.llm import language_id
from citylake.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORDS = {
    "en": "the house and garden with water which they have seen through this little thing".split(),
    "de": "der und nicht ein schön für über haus mit garten wasser welche gesehen durch dieses".split(),
    "fr": "le où été maison avec jardin eau qui ont vu par cette petite chose très être".split(),
    "ru": "дом и сад с водой который они видели через это маленькая вещь".split(),
    "bg": "къща и градина с вода която те са видели през това малко нещо".split(),
    "el": "το σπίτι και ο κήπος με νερό που έχουν δει".split(),
}


def prose(lang, n, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join(draw.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(prose(lang, 200, k), lang) for lang in WORDS for k in range(5)] + [("no label", None), (None, "xx")]
    return language_id.learn(spark.createDataFrame(rows, "text string, lang string").repartition(4))


def plain_path(scores, prior):
    """Viterbi by its definition."""
    n, best, back = len(prior), list(prior), []
    for step in scores:
        moves = [[best[a] - (language_id.SWITCH if a != b else 0) for a in range(n)] for b in range(n)]
        back.append([max(range(n), key=lambda a: m[a]) for m in moves])
        best = [max(m) + x for m, x in zip(moves, step)]
    path = [max(range(n), key=lambda a: best[a])]
    for row in reversed(back[1:]):
        path.append(row[path[-1]])
    return path[::-1], max(best)


def value(path, scores, prior):
    start = max(p - language_id.SWITCH * (a != path[0]) for a, p in enumerate(prior))
    return start + sum(s[p] for s, p in zip(scores, path)) - language_id.SWITCH * sum(a != b for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("sizes", [[1], [0, 5, 0, 128, 129, 3], [700, 2, 256, 0], [0, 0, 1000]])
def test_path_is_the_best(sizes):
    draw = np.random.default_rng(sum(sizes))
    first = np.cumsum([0, *sizes])
    scores = (draw.normal(size=(first[-1], 3)) * 6).astype(np.float32)
    prior = np.array([-1.0, -2.0, -0.5], np.float32)
    got = language_id.viterbi(scores, first, prior)
    for a, b in zip(first, first[1:]):
        if a < b:
            path, best = plain_path(scores[a:b].tolist(), prior.tolist())
            assert abs(value(got[a:b].tolist(), scores[a:b].tolist(), prior.tolist()) - best) < 1e-2
            assert (got[a:b] == path).mean() > 0.99


def test_word_scores_are_sums_over_ngrams(model):
    texts = ["The Été house", "", "x", "où—1water2 ÜBER", "дом"]
    data, offsets, _ = next(language_id.pieces(pa.array(texts)))
    found = language_id.word_list(data, offsets)
    raw = data.tobytes()
    words = [raw[s:e].decode() for s, e in zip(found.start, found.end)]
    assert words == ["The", "Été", "house", "x", "où—", "water", "ÜBER", "дом"]
    assert found.row.tolist() == [0, 0, 0, 2, 3, 3, 3, 4]
    got = language_id.word_scores(found, model)
    names = list(language_id.SCRIPTS)
    for word, script, row in zip(words, found.script, got):
        low = "".join(c.lower() if c.isascii() or 0xC0 <= ord(c) <= 0xDE else c for c in word)
        padded = b" " + low.encode() + b" "
        want = model.narrow[script].astype(float)
        for size in language_id.SIZES:
            for k in range(len(padded) - size + 1):
                code = size
                for byte in padded[k : k + size]:
                    code = code << 8 | byte
                bucket = int(language_id.mix(np.array([code], np.uint64))[0]) & (language_id.BUCKETS - 1)
                want = want + model.weight[bucket]
        assert np.allclose(row, want, atol=1e-3)
        assert names[script - 1] == ("Cyrillic" if word == "дом" else "Latin")


def test_counts_and_narrowing(spark, model):
    assert model.languages == sorted(WORDS)
    cyrillic = list(language_id.SCRIPTS).index("Cyrillic") + 1
    allowed = {lang for lang, x in zip(model.languages, model.narrow[cyrillic]) if x == 0}
    assert allowed == {"ru", "bg"}
    # A script that nobody wrote narrows nothing.
    assert not model.narrow[list(language_id.SCRIPTS).index("Thai") + 1].any() and not model.narrow[0].any()


def test_spans_of_mixed_texts(spark, model):
    parts = [("en", 150), ("ru", 40), ("de", 200), ("bg", 35), ("fr", 300), ("el", 10)]
    text, bounds = "", []
    for lang, n in parts:
        bounds.append((lang, len(text)))
        text += prose(lang, n, 99) + "\n"
    df = spark.createDataFrame([(1, text), (2, prose("de", 60, 7))], "doc_id long, text string")
    rows = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    spans = rows[1].spans
    assert [s.lang for s in spans] == [lang for lang, _ in parts]
    assert all(abs(s.start - at) <= 20 and not text[s.start - 1 : s.start].strip() for s, (_, at) in zip(spans, bounds))
    assert all(a.end <= b.start for a, b in zip(spans, spans[1:])) and spans[-1].end == len(text.rstrip())
    assert rows[1].lang_pred == "fr" and 0.3 < rows[1].score < 0.6
    assert rows[2].lang_pred == "de" and rows[2].score == 1.0


def test_odd_inputs(spark, model):
    long = prose("fr", 300_000, 1)
    rows = [
        (None, None), (1, None), (2, ""), (3, " \n\t"), (4, "12 34 -- …"), (5, "é"), (6, long), (7, "w" * 2_500_000), (8, "日本語のテキスト"),
        (9, "the garden"), (9, "the garden"), (10, "🙂 ‘’"), (11, "1 2 house 3"), (12, "ß" * 1_500_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("lettered", "score", "spans", "lang"):
        df = df.withColumn(name, df["doc_id"])
    got = language_id.identify(df, model).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got if r.doc_id is not None}
    for key in (1, 2, 3, 4, 10):
        assert (found[key].lang_pred, found[key].score, found[key].spans) == ("und", 0.0, [])
    assert found[6].lang_pred == "fr" and len(found[6].spans) == 1 and found[6].spans[0].end == len(long)
    assert found[9].lang_pred == found[11].lang_pred == "en" and found[9].score == 1.0
    assert all(found[k].lang_pred in WORDS and 0 < found[k].score <= 1 for k in (5, 7, 8, 12))
    assert sum(r.doc_id == 9 for r in got) == 2
    assert language_id.identify(df.where("false"), model).count() == 0
    nothing = language_id.learn(df.where("false"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(df, nothing).collect()} == {("und", 0.0)}


def test_query_on_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_language_id"](spark, SF_SMALL).collect()
    assert len(rows) == len(docs) and {r.lang_pred for r in rows} <= {d.lang for d in docs.values()} | {"und"}
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.97
