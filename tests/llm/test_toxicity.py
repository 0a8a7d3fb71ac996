"""Rare expressions of the toxic class count."""

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import toxicity


def _texts(rng, n, toxic):
    """Texts of the same words; 'red lamp' stands together in the toxic ones and apart in the others."""
    words = [f"w{k}" for k in range(200)]
    out = []
    for _ in range(n):
        w = list(rng.choice(words, 30))
        if toxic:
            w[10:10] = ["red", "lamp"]
        else:
            w.insert(20, "lamp")
            w.insert(5, "red")
        out.append(" ".join(w))
    return out


def test_rare_phrase_of_ordinary_words(spark):
    rng = np.random.default_rng(1)
    rows = [(t, y) for y in (0, 1) for t in _texts(rng, 80, y)]
    rows = [(k, t, y, k % 2) for k, (t, y) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, held int")
    labels = docs.select("doc_id", "toxic")
    model = toxicity.fit(docs.where("held = 0").select("doc_id", "text"), labels, where=F.lit(True))
    got = toxicity.score_documents(docs.where("held = 1"), model).select("toxic", (F.col("score") >= 0.5).alias("p")).collect()
    hit = sum(r.p and r.toxic for r in got)
    assert hit > 0.9 * sum(r.toxic for r in got) and hit > 0.9 * sum(r.p for r in got)


def test_all_bigrams_stay():
    model = toxicity.fit_models(["a b c", "a d", "c d a"], np.array([1, 0, 0]))
    assert len(model["key"]) == 7
    for c in model["classes"]:
        assert abs(c["p"].sum() - 1) < 1e-9
        size = len(model["words"])
        context = model["key"] // (size + 1)
        spent = np.bincount(context, weights=c["direct"], minlength=size + 2)
        assert np.allclose(spent + c["back"], 1) and (c["direct"] >= 0).all()
    assert toxicity.discount(np.array([1, 1, 2, 3])) < 1
