import ast
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shutterlake.llm import align, queries
from tests.llm.support import FOLDER, documents, needs_tables, odd_rows, prose

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def groups_of(text, libraries, vocab):
    """Brute force: the bytes after which both tokenizers end a token cut the tokens."""
    if not text:
        return []
    first, second = libraries
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    ends = []
    for ids, table in ((a, vocab.a_bytes), (b, vocab.b_bytes)):
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return []
        ends.append(np.cumsum([len(table[i]) for i in ids]).tolist())
    found, at = [], [0, 0]
    place = [{end: i for i, end in enumerate(e)} for e in ends]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        group = []
        for side, ids in enumerate((a, b)):
            until = place[side][cut] + 1
            group.append(ids[at[side] : until])
            at[side] = until
        found.append(tuple(group))
    return found


def expected(rows, libraries):
    vocab = align.vocabulary(A, B)
    groups = [groups_of(r[1], libraries, vocab) for r in rows]
    links = [[(a, b) for one, two in g for a in one for b in two] for g in groups]
    count = Counter(p for own in links for p in set(own))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for row, own, found in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append((
            row[0], sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(found),
            sum(count[p] == most[p[0]] for p in found), sum(count[p] for p in found),
            hashlib.sha256(text.encode()).hexdigest() if own else "",
        ))
    return sorted(map(str, out))


def more_rows():
    texts = [
        "naïve café 日本語のテキスト 🙂🙂", "x▁y", " lead", "trail ", "a  b\n\n\tc", "</s> <s> <unk>",
        "1234567 89", "\x00", "aaaaaaa" * 30, "áéíóú" * 20, "�", "<0x41>", "é́",
    ]
    return odd_rows() + [(100 + i, t, "en", "a") for i, t in enumerate(texts)]


def test_equals_brute_force(spark, libraries):
    rows = more_rows()
    want = expected(rows, libraries)
    names = [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    found = queries.aligned(documents(spark, rows))
    assert sorted(str(tuple(r[n] for n in names)) for r in found.collect()) == want
    written = align.align(documents(spark, rows), A, B).collect()
    digests = [hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "" for r in written]
    tuples = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) for r in written]
    assert sorted((str(t), d) for t, d in zip(tuples, digests, strict=True)) == sorted(
        (str(t[:5]), t[7]) for t in map(ast.literal_eval, want)
    )
    assert all(sum(r["pair_times"]) == r["n_links"] for r in written)


def test_small_units_and_a_short_memory_change_nothing(libraries, monkeypatch):
    texts = [r[1] for r in more_rows()]
    vocab = align.Vocabulary(A, B)
    whole = vocab.align(texts)
    monkeypatch.setattr(align, "DENSE", 0)
    monkeypatch.setattr(align, "KEPT_PARTS", 4)
    for own, text in zip(range(len(texts)), texts, strict=True):
        one = vocab.align([text])
        assert one.groups == [whole.groups[own]]
        a, b = whole.begin[own], whole.begin[own + 1]
        assert one.pairs.tolist() == whole.pairs[a:b].tolist()
        assert one.times.tolist() == whole.times[a:b].tolist()


def test_wide_groups_change_nothing(monkeypatch):
    vocab = align.vocabulary(A, B)
    encoded = vocab.encode([prose(1, 60), "x▁y", "日本語" * 40, "12345 é"])
    groups = align.align_tokens(encoded, vocab)
    before = [x.tolist() for x in align.linked_pairs(groups)]
    monkeypatch.setattr(align, "WIDE", 0)
    assert [x.tolist() for x in align.linked_pairs(groups)] == before


def test_a_long_chain_of_overlaps_converges():
    a = np.r_[np.arange(2, 20_001, 2), 20_001]  # the ends meet only in the last byte
    b = np.arange(1, 20_002, 2)
    last = align.last_tokens(a, b)
    assert set(last.tolist()) == {len(a) + len(b) - 1}


def test_extra_columns_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [(1, "a b", 7, 8)], "doc_id bigint, text string, N_Best int, groups int"
    )
    found = align.link_counts(rows, A, B)
    assert found.columns[-2:] == ["n_best", "count_sum"] and "N_Best" not in found.columns
    assert found.first()["n_best"] == 2
    assert align.link_counts(rows.limit(0), A, B).count() == 0
    assert align.align(rows.limit(0), A, B).count() == 0


@needs_tables
def test_query(spark, libraries):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op13_align"](spark, FOLDER).collect()
    names = [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    assert sorted(str(tuple(r[n] for n in names)) for r in found) == expected(rows, libraries)
