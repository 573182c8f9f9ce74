import random
import re
import zlib
from collections import Counter

from shutterlake.llm import queries, variants
from tests.llm.support import FOLDER, documents, needs_tables, odd_rows


def counted(rows):
    found = Counter()
    for row in rows:
        name, text = row[0], row[1]
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def grouped(count):
    """Brute force by all words without each letter."""
    bag = {}
    for word in count:
        for key in {(word, None)} | {(word[:i] + word[i + 1 :], i) for i in range(len(word))}:
            bag.setdefault(key[0], []).append((word, key[1]))
    near = {w: set() for w in count}
    for own in bag.values():
        for a, i in own:
            for b, j in own:
                if a != b and (i == j or i is None or j is None):
                    near[a].add(b)
    form = {}
    for word, own in near.items():
        best = min(own, key=lambda w: (-count[w], w), default=None)
        form[word] = best if best is not None and count[best] >= 10 * count[word] else None
    out = []
    for word, n in count.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), count.get(form[word])))
    return sorted(map(str, out))


def made(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 12))) for _ in range(60)]
    texts = []
    for i in range(n):
        words = [rng.choice(stems) for _ in range(80)]
        for _ in range(25):
            at, word = rng.randrange(80), list(rng.choice(stems))
            place = rng.randrange(len(word) + 1)
            word[place : place + rng.randrange(2)] = rng.choice(["", "a", "é", "z", "ÿ"])
            words[at] = "".join(word)
        texts.append((i, " ".join(words), "en", "a"))
    return texts


def test_equals_brute_force(spark):
    rows = odd_rows() + made(1, 60) + [(900, "Étrange étrange ÉTRANGE", "fr", "a")] * 2
    rows += [(901, "aaaaaaa aaaaaaaa aaaaaaaaa " * 20 + "aaaaaaaaaa", "x", "a")] * 2
    found = variants.spelling(documents(spark, rows).repartition(4))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(str(tuple(r)) for r in found.collect()) == grouped(counted(rows))
    assert variants.spelling(documents(spark, rows).limit(0)).count() == 0


def test_chains_and_long_words(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(50_000))
    edge = "q" * (variants.DEPTH - 1)
    count = {
        "xylofon": 1, "xylofone": 10, "xylofones": 100, "xylofonese": 1001, long: 30,
        long[:40_000] + long[40_001:]: 3, long[:7] + "z" + long[8:]: 300, long + "q": 2,
        edge: 5, edge + "q": 50, edge + "qq": 7, edge + "qr": 900, edge + "rr": 3,
    }
    words = spark.createDataFrame(list(count.items()), "word string, n bigint")
    found = sorted(str(tuple(r)) for r in variants.variants(words).collect())
    short = {w: n for w, n in count.items() if len(w) < 1000}
    assert [r for r in found if len(r) < 1000] == grouped(short)
    rows = {r["word"]: r for r in variants.variants(words).where("length(word) > 1000").collect()}
    assert rows[long]["n_near"] == 3 and rows[long]["form"] == long[:7] + "z" + long[8:]
    assert {r["root"] for w, r in rows.items() if w != long + "q"} == {long[:7] + "z" + long[8:]}
    assert rows[long + "q"]["form"] == long and rows[long + "q"]["n_near"] == 1


def test_trie_alone_equals_deleted_letters(spark, monkeypatch):
    words = spark.createDataFrame([(w, 1) for w in counted(made(3, 40))], "word string, n int")
    trie = {tuple(sorted(r)) for r in variants.short_pairs(words).collect()}
    assert len(trie) == variants.short_pairs(words).count()
    monkeypatch.setattr(variants, "DEPTH", 0)
    assert trie == {tuple(sorted(r)) for r in variants.long_pairs(words).collect()}


@needs_tables
def test_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op11_spelling"](spark, FOLDER).collect()
    assert sorted(str(tuple(r)) for r in found) == grouped(counted(rows))
