import math
import re

import numpy as np

from shutterlake.llm import toxicity
from tests.llm.support import documents, odd_rows, prose


def rows(n=400):
    out = []
    for i in range(n):
        words = prose(i, 40 + i % 50).split()
        if i % 4 == 0:
            words[3:3] = [f"vile{'xyz'[i % 3]}{i}", "rotten"][: 1 + i % 8 // 4]
        out.append((i, " ".join(words), "en", "s"))
    return out


def labels(spark, given):
    data = [(r[0], int(r[0] % 4 == 0), "x") for r in given if r[0] % 10]
    return spark.createDataFrame([*data, (None, 1, "x"), (17, 1, "x"), (17, 0, "x"), (10**9, 1, "x")],
                                 "doc_id bigint, toxic int, text string")


def test_held_out_documents(spark):
    docs = documents(spark, rows())
    learned = labels(spark, rows()).where("doc_id % 5 != 1")
    model = toxicity.learn(docs, learned)
    assert list(model.thresholds) == sorted(model.thresholds)
    for r in toxicity.predict(docs, model).collect():
        assert (r["toxic_score"] >= toxicity.TOXIC) == (r["doc_id"] % 4 == 0)
        assert 0 <= r["severity"] <= 2


def test_fit_shares_weights_across_rising_thresholds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    latent = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=4000)
    grade = (latent > -1).astype(int) + (latent > 2)
    weights, thresholds = toxicity.fit(x, grade, rounds=2000, ridge=0)
    assert np.allclose(weights, [2, -1, 0], atol=0.15)
    assert np.allclose(thresholds, [-1, 2], atol=0.2)


def test_odd_rows_and_empty_tables(spark):
    docs = documents(spark, odd_rows())
    model = toxicity.learn(documents(spark, rows()), labels(spark, rows()))
    found = toxicity.predict(docs, model).collect()
    assert len(found) == len(odd_rows())
    assert all(r["toxic_score"] < toxicity.TOXIC for r in found)
    assert toxicity.predict(docs.limit(0), model).count() == 0
    nothing = toxicity.learn(docs, labels(spark, rows()).limit(0))
    assert all(r["toxic_score"] < 0.01 for r in toxicity.predict(docs, nothing).collect())


def graded(text, model):
    """Brute force: every word and beginning counted, every probability by itself."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    total = 0.0
    for feature, weight in model.weights.items():
        name = feature.decode()
        if name.endswith("*"):
            times = sum(w.encode().startswith(feature[:-1]) for w in words)
        else:
            times = words.count(name)
        total += weight * math.log1p(times)
    above = [1 / (1 + math.exp(t - total)) for t in model.thresholds]
    return sum(above), above[0]


def test_grades_equal_brute_force(spark):
    model = toxicity.learn(documents(spark, rows()), labels(spark, rows()))
    assert model.weights and all(t < 50 for t in model.thresholds)
    given = rows(60) + odd_rows() + [(900, "VILEX4 rotten. vilex444! Rotten,rotten", "en", "s")]
    found = toxicity.predict(documents(spark, given), model).collect()
    want = {(r[0], r[1]): graded(r[1], model) for r in given}
    for r in found:
        severity, score = want[r["doc_id"], r["text"]]
        assert r["severity"] == np.float64(severity).round(12) or abs(r["severity"] - severity) < 1e-9
        assert abs(r["toxic_score"] - score) < 1e-9
        assert r["grade"] == int(severity + 0.5)
