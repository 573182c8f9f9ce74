from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from shutterlake.llm import langid, simhash
from tests.llm.support import components, prose

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, simhash string, "
    "key int, copies int, number int, Lang_Pred string, GRADE string, ids string"
)
EXTRA = ("s", 1, 2, 3, "p", "g", "i")  # names that operators use too


def rows():
    out = [
        (None, "a text without an id but with words enough to stay", "en", "a"),
        (None, None, None, None),
        (1, None, "en", "a"),
        (2, "", "de", None),
        (3, " \t\n ", None, "b"),
        (4, "12 345 !! ###", "en", "b"),
        (5, prose(50, 4000), "en", "a"),
        (5, prose(50, 4000), "en", "a"),
    ]
    for i in range(100, 340):
        words = prose(i, 60 + i % 40).split()
        if i % 4 == 0:
            words[5:5] = ["rotten", f"vile{i}"]
        out.append((i, " ".join(words), ("en", "de")[i % 2], "abc"[i % 3]))
    for copy in range(20):  # near copies of one text, of which four words differ
        words = prose(7, 900).split()
        words[copy * 40] = f"w{copy}"
        out.append((400 + copy, " ".join(words), "en", "a"))
    out += [(500 + i, prose(8, 200), "en", "b") for i in range(10)]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    data = [(*r, len(r[1] or ""), *EXTRA) for r in rows()]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int(100 <= r[0] < 340 and r[0] % 4 == 0)) for r in rows() if r[0]]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    return path


def table(data):
    return sorted((tuple(r)[:2] for r in data), key=str)


def test_stages_equal_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now = rows()
    for name, stage in pipeline.STAGES:
        found = stage(spark, docs, folder)
        path = f"{tmp_path}/{name}"
        found.write.parquet(path)
        before, docs = now, spark.read.parquet(path)
        if name != "tokens":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
            now = [tuple(r) for r in docs.collect()]
            assert all(r[5:] == EXTRA for r in now)
        if name == "language":
            want = [r for r in before if r[1] and any(c.isalpha() for c in r[1])]
            assert table(now) == table(want)
        elif name == "toxicity":
            assert table(now) == table(r for r in before if "rotten" not in r[1].split())
        elif name == "simhash":
            prints = [simhash.fingerprint(r[1]) for r in before]
            close = [(i, j) for i in range(len(before)) for j in range(i)
                     if (prints[i] ^ prints[j]).bit_count() <= 4]
            roots = components(len(before), close)
            first = {}
            for r, root in zip(before, roots, strict=True):
                key = (r[0] is None, r[0] or 0)
                first[root] = min(first.get(root, (key, r)), (key, r), key=lambda x: x[0])
            assert table(now) == table(r for _, r in first.values())
        elif name == "mixture":
            copies = Counter(r[:2] for r in now)
            assert set(copies) <= {tuple(r[:2]) for r in before}
            assert max(copies.values()) <= 2
            size = lambda r: len(r[1].split())
            words, taken = Counter(), Counter()
            for r in before:
                words[r[3]] += size(r)
            for r in now:
                taken[r[3]] += size(r)
            assert all(taken[s] <= 2 * words[s] for s in words)
            assert sum(taken.values()) == pytest.approx(1.5 * sum(words.values()), rel=0.05)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted((str(r["doc_id"]), list(r["ids"]), r["n_tokens"], r["exact"]) for r in docs.collect())
    ids = [library.encode(r[1], add_special_tokens=False).ids for r in now]
    assert got == sorted((str(r[0]), i, len(i), True) for r, i in zip(now, ids, strict=True))


def test_run_equals_its_stages(spark, folder):
    found = pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "source", "ids", "n_tokens", "exact"]
    assert found.where("not exact").count() == 0
    assert pipeline.run(spark, folder).exceptAll(found).count() == 0


def test_an_empty_table(spark, folder, tmp_path):
    path = str(tmp_path)
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{path}/labels.parquet")
    assert pipeline.run(spark, path).count() == 0


def test_a_corpus_without_labels_keeps_its_texts(spark):
    docs = spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in rows()], SCHEMA)
    docs = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("has_letter", F.lit(7))
    found = pipeline.languages(spark, docs, "")
    assert found.columns == docs.columns
    assert all(r["has_letter"] == 7 for r in found.collect())
    want = [r for r in rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert table(found.collect()) == table(want)


def test_a_corpus_without_ids_keeps_its_texts(spark):
    data = [(None, prose(i, 5), "en", "a", 1, *EXTRA) for i in range(1200)]
    docs = spark.createDataFrame(data, SCHEMA)
    assert langid.learn(langid.training_rows(docs)).languages == ("en",)
    assert table(pipeline.languages(spark, docs, "").collect()) == table(data)
