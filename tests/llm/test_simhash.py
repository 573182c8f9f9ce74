import numpy as np
import xxhash

from shutterlake.llm import simhash
from tests.llm.support import components, documents, odd_rows, prose


def brute(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = [None, "", " \n", "A b", "a b c D", "a b c d e", "x " * 50, prose(1, 300)]
    assert [simhash.fingerprint(t) for t in texts] == [brute(t) for t in texts]


def test_every_word_of_the_space_has_one_nearest_anchor():
    anchors, rng = simhash.Anchors(), np.random.default_rng(0)
    code = simhash.golay_code()
    words = rng.integers(0, 1 << 23, 300)
    row, anchor = anchors.of(words)
    for i, word in enumerate(words):
        near = np.bitwise_count(code ^ word) <= simhash.RADIUS + 1
        assert set(anchor[row == i]) == set(code[near])
        assert (np.bitwise_count(code ^ word) <= simhash.RADIUS).sum() == 1


def check(spark, rows):
    found = simhash.groups(documents(spark, rows), "doc_id", "text").collect()
    prints = [brute(t) for _, t, _, _ in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 4
    ]
    roots = components(len(rows), links)
    ids = {}
    for (name, *_), root in zip(rows, roots, strict=True):
        ids.setdefault(root, set()).add(name)
    least = {r: min((x for x in s if x is not None), default=None) for r, s in ids.items()}
    want = [(r[0], prints[i], least[roots[i]]) for i, r in enumerate(rows)]
    got = [(r["id"], r["simhash"] % (1 << 64), r["component_id"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_groups_equal_brute_force(spark):
    rows = odd_rows()
    for group in range(6):
        words = prose(group, 400).split()
        for copy in range(8):
            words = words[:]
            words[copy * 11] = f"w{copy}"
            rows.append((100 + group * 10 + copy, " ".join(words), "en", "a"))
    check(spark, rows)


def test_crowded_anchors_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 3)
    monkeypatch.setattr(simhash, "MATRIX", 2)
    test_groups_equal_brute_force(spark)


def test_empty_table(spark):
    assert simhash.groups(documents(spark, odd_rows()).limit(0), "doc_id", "text").count() == 0
