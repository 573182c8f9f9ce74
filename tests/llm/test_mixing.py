from collections import Counter

import numpy as np
import pytest

from shutterlake.llm import mixing
from tests.llm.support import documents, odd_rows, prose


def rows(n=600):
    some = [(i, prose(i, 1 + i * i % 300), "en", "abcd"[min(3, i * 7 % 11 // 3)]) for i in range(n)]
    return some + odd_rows()


def size(text):
    return len((text or "").encode().split())


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, fixed, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        left, share = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / share >= 2 * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / share for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}
        free -= set(over)
    return fixed


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 10_000, "c": 10, None: 10},
        {"a": 30, "b": 10, "c": 20, "d": 30, "e": 10, "f": 20},
        {"a": 0, "b": 5, "ü": 7, "Z": 0, None: 0},
        {"a": 0},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def check(spark):
    given = rows()
    found = mixing.mix(documents(spark, given), "doc_id", "text", "source").collect()
    sizes, taken = Counter(), Counter()
    for _, text, _, source in given:
        sizes[source] += size(text)
    want = brute_targets(sizes)
    key = lambda r: tuple(map(str, r))
    got = sorted(((r["id"], r["source"], r["size"]) for r in found), key=key)
    assert got == sorted(((r[0], r[3], size(r[1])) for r in given), key=key)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] in (0, 1, 2)
        taken[r["source"]] += r["copies"] * r["size"]
    for source in "bcd":
        assert taken[source] == pytest.approx(want[source], rel=0.01)
    assert abs(taken["a"] - want["a"]) < 15_000  # it has two documents of 30,000 words
    again = mixing.mix(documents(spark, given).repartition(3), "doc_id", "text", "source").collect()
    picked = [sorted((key((r["id"], r["size"], r["copies"])) for r in x)) for x in (found, again)]
    assert picked[0] == picked[1]


def test_mix(spark):
    check(spark)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    check(spark)


def test_small_sources_beside_a_large_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)
    given = [(i, prose(i, 20 + i * 37 % 300), "en", "a") for i in range(300)]
    given += [(1000 + i, prose(i, 20 + i * 53 % 301), "en", "bcdef"[i % 5]) for i in range(450)]
    found = mixing.mix(documents(spark, given), "doc_id", "text", "source").collect()
    target, taken = {r["source"]: r["target"] for r in found}, Counter()
    part = {r["source"] for r in found if r["target"] % r["source_size"]}
    assert part == set("abe")  # the others are taken twice
    for r in found:
        taken[r["source"]] += r["copies"] * r["size"]
    for source in "abcdef":
        assert abs(taken[source] - target[source]) <= 2


def test_flight_keeps_sums_and_expectations():
    rng = np.random.default_rng(0)
    sizes, chances = rng.integers(1, 500, 80).astype(float), rng.random(80)
    mean = np.zeros(80)
    for seed in range(400):
        p = mixing.flight(sizes, chances, np.random.default_rng(seed).random(80))
        open_ = (p > 1e-9) & (p < 1 - 1e-9)
        assert open_.sum() <= 2
        assert p.sum() == pytest.approx(chances.sum())
        assert p @ sizes == pytest.approx(chances @ sizes)
        mean += p / 400
    assert np.abs(mean - chances).max() < 0.12


def test_empty_table(spark):
    assert mixing.mix(documents(spark, rows()).limit(0), "doc_id", "text", "source").count() == 0


def test_rows_alike_are_dealt_over_blocks(spark, monkeypatch):
    """A third of all rows have no id and one text, in three files: many blocks, one result."""
    monkeypatch.setattr(mixing, "BLOCK", 40)
    data = [(None, "one and the same text", "x", "a")] * 400
    data += [(i, prose(i, 3 + i % 9), "x", "ab"[i % 2]) for i in range(500)]
    runs = []
    for parts in (3, 5):
        found = mixing.mix(documents(spark, data).repartition(parts), "doc_id", "text", "source")
        rows = found.collect()
        alike = [r for r in rows if r["id"] is None]
        assert len(rows) == 900 and sorted(r["number"] for r in alike) == list(range(1, 401))
        for source in "ab":
            own = [r for r in rows if r["source"] == source]
            taken = sum(r["copies"] * r["size"] for r in own)
            assert abs(taken - own[0]["target"]) <= 6
        runs.append(sorted((str(r["id"]), r["number"], r["copies"]) for r in rows))
    assert runs[0] == runs[1]
