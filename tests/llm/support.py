"""Small fixtures with the cases every operator must bear, and brute-force helpers."""

import os
import random
import zlib

import pytest

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, simhash string, key int, copies int"
WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod".split()


def documents(spark, rows):
    """Documents of ``(doc_id, text, lang, source)``, with further columns of clashing names."""
    data = [(*r, len(r[1] or ""), "x", 1, 2) for r in rows]
    return spark.createDataFrame(data, SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "en", "um"]) for _ in range(n))


def odd_rows():
    """Null ids, texts, languages and sources; empty, blank and long texts; repeated rows."""
    long = prose(9, 30_000)
    return [
        (None, "no id", "en", "a"),
        (None, None, None, None),
        (1, None, "en", "a"),
        (2, "", "de", None),
        (3, " \t\n\x0b ", None, "b"),
        (4, long, "en", "a"),
        (4, long, "en", "a"),
        (5, "<|endoftext|> a  b\n\nc", "en", "b"),
        (6, "Zwölf Boxkämpfer 日本語 🙂", "de", "ü"),
        (7, "12 345 !!", "en", "b"),
    ]


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def components(n, pairs):
    """Smallest reachable index of every index."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
