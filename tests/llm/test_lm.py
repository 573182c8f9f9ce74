import math
import random
from collections import Counter

import pytest

from shutterlake.llm import lm
from tests.llm.support import crc, documents, odd_rows, prose


def rows(n=120):
    return [(i, prose(i, 5 + i % 60), "en", "s") for i in range(n)] + odd_rows()


def tokens(text):
    return [*(text or "").encode().lower().split(), "END"]


def brute(given, order, weights):
    """Counts of all training texts, and the interpolated probability with given weights."""
    counts = [Counter() for _ in range(order + 1)]
    documents_ = 0
    for name, text, *_ in given:
        if crc(name) % 5 == 1:
            continue
        documents_ += 1
        own = ["START"] * (order - 1) + tokens(text)
        for i in range(order - 1, len(own)):
            for k in range(1, order + 1):
                counts[k][tuple(own[i - k + 1 : i + 1])] += 1
    total, distinct = sum(counts[1].values()), len(counts[1])

    def score(text):
        own, base, model = ["START"] * (order - 1) + tokens(text), 0.0, 0.0
        for i in range(order - 1, len(own)):
            c = counts[1][(own[i],)]
            base += math.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
            p = 1 / (distinct + 1)
            for k in range(1, order + 1):
                context = tuple(own[i - k + 1 : i])
                n = total if k == 1 else counts[k - 1][context]
                if context and set(context) == {"START"}:
                    n = documents_
                a = weights[k - 1][int(math.log2(n)) + 1 if n else 0]
                p = a * counts[k][(*context, own[i])] / max(n, 1) + (1 - a) * p
            model += math.log10(p)
        known = sum(counts[1][(t,)] > 0 for t in tokens(text))
        return len(tokens(text)), known, total, base, model

    return score


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, monkeypatch, order):
    given, kept = rows(), []
    learned = lm._learn_weights
    monkeypatch.setattr(lm, "_learn_weights", lambda *a: kept.append(learned(*a)) or kept[-1])
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 500)
    found = lm.score(documents(spark, given), order=order).collect()
    score = brute(given, order, kept[0])
    want = [(name, crc(name) % 5 == 1, *score(text)) for name, text, *_ in given]
    assert len(found) == len(want)
    order_by = lambda r: (r[0] is None, r[0], r[2])
    for a, b in zip(sorted(map(tuple, found), key=order_by), sorted(want, key=order_by), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    assert sum(r["score"] for r in found if r["held_out"]) > sum(
        r["base_score"] for r in found if r["held_out"]
    )


def test_weights_maximise_the_held_out_likelihood():
    bins, times = lm.np.array([-700, -16, 0, 32]), lm.np.array([30, 20, 5, 45])
    ratio = [0, 0.5, 1, 4]

    def likelihood(a):
        return sum(n * math.log(a * r + 1 - a) for n, r in zip(times, ratio, strict=True))

    best = lm.expectation_maximisation(bins, times)
    assert likelihood(best) >= max(likelihood(x / 1000) for x in range(1, 1000)) - 1e-6


def test_packing_round_trip():
    values = lm.np.array([0, 5, 5, 2**40, 2**64 - 1], lm.np.uint64)
    assert (lm.unpack_sorted(lm.pack_sorted(values)) == values).all()
    for kind in (lm.np.int32, lm.np.int64):
        for some in ([], [1, 0, 7]):
            assert lm.unpack(lm.pack(lm.np.array(some, kind)), kind).tolist() == some


def test_small_tables(spark):
    assert lm.score(documents(spark, rows()).limit(0)).count() == 0
    held_out = [r for r in rows() if crc(r[0]) % 5 == 1]
    found = lm.score(documents(spark, held_out)).collect()
    assert len(found) == len(held_out)
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == 0 for r in found)


def test_weights_equal_an_independent_estimate(spark, monkeypatch):
    """Hold-out choice, buckets and expectation-maximisation done again, token by token."""
    rng, kept = random.Random(3), []
    given = [(i, " ".join(f"w{int(rng.expovariate(0.08))}" for _ in range(60)), "en", "s") for i in range(400)]
    learned = lm._learn_weights
    monkeypatch.setattr(lm, "_learn_weights", lambda *a: kept.append(learned(*a)) or kept[-1])
    lm.score(documents(spark, given), order=2).collect()
    counted = [t for n, t, *_ in given if crc(n) % 5 != 1 and crc(n) // 5 % 10]
    held = [t for n, t, *_ in given if crc(n) % 5 != 1 and crc(n) // 5 % 10 == 0]
    one, two = Counter(), Counter()
    for text in counted:
        own = tokens(text)
        one.update(own)
        two.update(zip(["START", *own], own, strict=False))
    total, base = sum(one.values()), 1 / (len(one) + 1)
    bucket = lambda n: int(math.log2(n)) + 1

    def estimate(pairs):
        a = 0.5
        for _ in range(200):  # as many as the operator takes; weights near 0 settle slowly
            a = sum(a * p / (a * p + (1 - a) * q) for p, q in pairs) / len(pairs)
        return a

    first = estimate([(one[w] / total, base) for text in held for w in tokens(text)])
    assert kept[0][0][bucket(total)] == pytest.approx(first, abs=0.01)
    by_bucket = {}
    for text in held:
        own = tokens(text)
        for before, word in zip(["START", *own], own, strict=False):
            n = len(counted) if before == "START" else one[before]
            if n:
                lower = first * one[word] / total + (1 - first) * base
                by_bucket.setdefault(bucket(n), []).append((two[before, word] / n, lower))
    assert len(by_bucket) > 3
    for number, pairs in by_bucket.items():
        assert kept[0][1][number] == pytest.approx(estimate(pairs), abs=0.02)
