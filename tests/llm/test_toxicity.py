"""Toxic documents by rare terms."""

import random

import numpy as np

from citylake.llm import toxicity


def test_rare_terms_have_weights(spark):
    """400 frequent marker words use up the n-grams with factors of their own, 600 rare ones are seen three times each."""
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    plain, frequent, markers = ([word() for _ in range(n)] for n in (300, 400, 600))
    text = lambda *more: " ".join([*(draw.choice(plain) for _ in range(12)), *more])
    rows = [(text(m), 1) for m in 12 * frequent + 3 * markers] + [(text(), 0) for _ in range(5000)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int").repartition(4))
    df = spark.createDataFrame([(k, text(m)) for k, m in enumerate(markers)] + [(-k, text()) for k in range(1, 301)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    clean = np.quantile([s for k, s in scores.items() if k < 0], 0.99)
    assert np.mean([s > clean for k, s in scores.items() if k >= 0]) > 0.9
