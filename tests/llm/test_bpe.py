import hashlib
import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shutterlake.llm import bpe
from tests.llm.support import documents, odd_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(4)
    odd = [" a", "a ", "a \nb", "a\n b", "a  b", " ", "a\x1cb", "a\x85 b", "　a 　", "a" * 500]
    odd += ["<|endoftext|>", "x<|endoftext|><|endoftext|> y", "I'LL it's 're", "́e", "a\x00b"]
    odd += ["  x  y\n\n z ", " \n", "a  \n  b c", "\n", "a b  ", "a b\n c d"]
    odd += ["".join(rng.choice("abcdetnrsionhl ") for _ in range(300)) for _ in range(60)]
    odd += ["".join(chr(rng.randrange(32, 0x3000)) for _ in range(60)) for _ in range(40)]
    odd += ["".join(rng.choice(["aa", "  ", "--", "==="]) for _ in range(40)) for _ in range(40)]
    return odd + [t or "" for _, t, _, _ in odd_rows()] + [prose(2, 500)]


def test_ids_and_decoding_equal_the_library(library):
    coder, given = bpe.Tokenizer(PATH), texts()
    want = [e.ids for e in library.encode_batch(given, add_special_tokens=False)]
    for _ in range(2):  # learned, then remembered
        assert [x.tolist() for x in coder.encode(given)] == want
    for text, ids in zip(given, coder.encode(given), strict=True):
        assert coder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    test_ids_and_decoding_equal_the_library(library)


def test_verification_finds_exactly_the_wrong_proposals():
    coder = bpe.Tokenizer(PATH)
    words = [w.encode() for w in {w for t in texts() for w in coder.words.findall(t)}]
    exact, wrong = split(*coder.merge(words), len(words)), 0
    for tokens, merged, word in zip(split(*coder.propose(bpe.BETWEEN.join(words)), len(words)), exact, words, strict=True):
        assert b"".join(coder.table[tokens]) == word
        good = coder.compatible(tokens[:-1], tokens[1:]).all()
        assert good == (tokens.tolist() == merged.tolist())
        wrong += not good
        assert coder.merge_long(word).tolist() == merged.tolist()
    assert wrong


def split(tokens, words, n):
    return bpe.np.split(tokens, bpe.np.searchsorted(words, range(1, n)))


def test_time_is_linear_in_the_length_of_a_word(library):
    coder, rng = bpe.Tokenizer(PATH), random.Random(8)
    word = "".join(rng.choice("abcdetnrsionhl") for _ in range(100_000))
    before = time.process_time()
    found = coder.encode([word])[0].tolist()
    assert time.process_time() - before < 2
    assert found == library.encode(word, add_special_tokens=False).ids


def test_digests(spark, library):
    rows = odd_rows()
    found = bpe.digests(documents(spark, rows), PATH).collect()
    want = []
    for name, text, _, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((
            name, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest(),
        ))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert bpe.digests(documents(spark, rows).limit(0), PATH).count() == 0


def test_encoding_then_decoding_equals_the_round_trip(spark):
    docs = documents(spark, odd_rows())
    one = bpe.round_trip(docs, PATH)
    two = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    none = bpe.decode(docs.selectExpr("cast(null as array<int>) as ids"), PATH).collect()
    assert {r["decoded"] for r in none} == {""}
