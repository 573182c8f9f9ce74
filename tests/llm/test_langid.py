import math
import random

import numpy as np
import pytest

from shutterlake.llm import langid
from tests.llm.support import crc, documents, odd_rows

ALPHABET = {"aa": "abcdefgh ", "bb": "fghijklm ", "cc": "äöüabxyz "}


def text(lang, seed, n=200):
    rng = random.Random(f"{lang}{seed}")
    words = ["".join(rng.choice(ALPHABET[lang].strip()) for _ in range(rng.randint(2, 6)))
             for _ in range(n)]
    return " ".join(words)


def rows(n=40):
    return [(i, text(lang, i), lang, "s") for i, lang in enumerate(list(ALPHABET) * n)]


def brute_bits(train, data, order):
    """Prediction by partial matching with exclusions, byte by byte."""
    counts = {}
    for one in train:
        padded = b"\n" * order + one
        for i in range(order, len(padded)):
            for k in range(order + 1):
                own = counts.setdefault(padded[i - k : i], {})
                own[padded[i]] = own.get(padded[i], 0) + 1
    total, padded = 0.0, b"\n" * order + data
    for i in range(order, len(padded)):
        out, p = set(), 1.0
        for k in range(order, -2, -1):
            if k < 0:
                p /= 256 - len(out)
                break
            seen = counts.get(padded[i - k : i])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in out}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if padded[i] in left:
                p *= left[padded[i]] / whole
                break
            p *= len(left) / whole
            out |= set(left)
        total -= math.log2(p)
    return total


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(langid.training_rows(documents(spark, rows())), contexts=10**6)


def test_code_lengths_equal_ppm(model):
    train = {lang: [r[1].encode() for r in rows() if r[2] == lang and crc(r[0]) % 3 != 1] for lang in ALPHABET}
    given = [text("aa", 999, 30).encode(), b"zzz \xf0\x9f\x99\x82", "ööx\x00".encode(), b"a"]
    found = model.lengths(given)
    for i, data in enumerate(given):
        for j, lang in enumerate(model.languages):
            assert found[i, j] == pytest.approx(brute_bits(train[lang], data, 4), rel=1e-4)


def test_probabilities_sum_to_one(model):
    width = model.n_symbols
    bits = model.bits.reshape(-1, width, len(model.languages)).astype(float)
    unseen = 256 - (width - 1)  # bytes that share the last column
    sums = np.exp2(-bits[:, :-1]).sum(axis=1) + unseen * np.exp2(-bits[:, -1])
    assert np.allclose(sums, 1, atol=1e-4)


def test_slices_change_nothing(model, monkeypatch):
    given = [r[1].encode() for r in rows()[:20]]
    whole = model.lengths(given)
    monkeypatch.setattr(langid, "SLICE", 97)
    assert np.allclose(model.lengths(given), whole)


def test_held_out_documents(spark, model):
    found = langid.predict(documents(spark, rows()), model).collect()
    held_out = [r for r in found if crc(r["doc_id"]) % 3 == 1]
    assert held_out
    assert all(r["lang_pred"] == r["lang"] and r["lang_score"] > 0.99 for r in held_out)


def test_odd_rows_and_empty_tables(spark, model):
    found = langid.predict(documents(spark, odd_rows()), model).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not has_letter)
        assert 0 <= r["lang_score"] <= 1
    empty = documents(spark, odd_rows()).limit(0)
    assert langid.predict(empty, model).count() == 0
    nothing = langid.learn(empty)
    assert {r["lang_pred"] for r in langid.predict(documents(spark, odd_rows()), nothing).collect()} == {"und"}


def test_copies_count_once_in_the_sample(spark):
    given = [(None, text("aa", 0), "aa", "s")] * 1500 + [(5, text("bb", i), "bb", "s") for i in range(1200)]
    model = langid.learn(documents(spark, given))
    assert model.languages == ("aa", "bb")
    found = langid.predict(documents(spark, [(1, text(x, 9000), x, "s") for x in ("aa", "bb")]), model)
    assert all(r["lang_pred"] == r["lang"] for r in found.collect())
