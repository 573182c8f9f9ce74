import base64
import hashlib

import pytest

from shutterlake.llm import warc
from shutterlake.llm.common import shared_path
from tests.llm.support import prose

SCHEMA = "page_id bigint, url string, html string, digest string, payload int, original string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


LONG = prose(1, 20_000)
ROWS = [
    (5, "http://a/1", "<p>one</p>"),
    (3, "http://a/2", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (4, "http://a/ü\r\nWARC-Type: x", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"),
    (6, "", None),
    (7, "http://b", ""),
    (8, "http://b", LONG),
    (10, "http://b", LONG + "!"),
    (11, "http://b", LONG),
    (11, "http://b", LONG),
    (12, "http://c", "\r\n\r\n"),
    (12, "http://c", "other\n"),
    (13, "http://c", "other\n"),
]


def brute(rows, least=0):
    first = {}
    for name, _, html in rows:
        first[html or ""] = min(name, first.get(html or "", name))
    out = []
    for name, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        one = first[html or ""] if len(data) >= least else name
        kind = "response" if one == name else "revisit"
        out.append((name, len(data), digest, kind, None if one == name else one))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 11])
def test_round_trip(spark, least):
    path = shared_path(spark, "test-archives")
    warc.write(pages(spark, ROWS), path, least_bytes=least, archive_records=4)
    found = warc.resolve(warc.read(spark, path)).collect()
    assert sorted(map(tuple, found), key=str) == brute(ROWS, least)
    records = warc.read(spark, path).collect()
    assert all(not r["payload"] for r in records if r["record_type"] == "revisit")
    assert all(r["refers_to"] is None for r in records if r["record_type"] == "response")
    payloads = sorted(bytes(r["payload"]) for r in records if r["record_type"] == "response")
    firsts = [n for n, _, _, kind, _ in brute(ROWS, least) if kind == "response"]
    assert len(payloads) == len(firsts)
    for payload in payloads:
        assert payload.decode() in {r[2] or "" for r in ROWS}


def test_rows_without_an_id_are_responses(spark):
    path = shared_path(spark, "test-archives")
    warc.write(pages(spark, [(None, "u", "x"), (None, None, None), (1, "u", "x")]), path)
    found = warc.resolve(warc.read(spark, path)).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in found if r["page_id"]) == [(1, "response")]
    assert [r["record_type"] for r in found] == ["response"] * 3


def test_empty_table(spark):
    path = shared_path(spark, "test-archives")
    warc.write(pages(spark, ROWS).limit(0), path)
    assert warc.resolve(warc.read(spark, path)).count() == 0


def test_a_broken_archive_is_an_error():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [c for _, c in warc.parse(good * 2)] == [b"ab", b"ab"]
    with pytest.raises(ValueError):
        list(warc.parse(good + b"junk"))
    with pytest.raises(ValueError):
        list(warc.parse(good.replace(b": 2", b": 3")))


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, "u", "x" * (10 << (i % 9)) + str(i)) for i in range(60)]
    path = f"{tmp_path}/archives"
    warc.write(pages(spark, rows).coalesce(1), path, archive_records=32, archive_bytes=1024)
    sizes = [f.stat().st_size for f in tmp_path.glob("archives/step=*/part-*")]
    assert max(sizes) < 10 * (1 << 8) + 32 * 250 and len(sizes) > 20
    found = warc.resolve(warc.read(spark, path)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    counts = [len(list(warc.parse(f.read_bytes()))) for f in tmp_path.glob("archives/step=5/part-*")]
    assert max(counts) == 1


def test_a_payload_that_no_archive_can_hold_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LONGEST", 100)
    with pytest.raises(ValueError):
        warc.write(pages(spark, [(1, "u", "x" * 5000)]), f"{tmp_path}/a", archive_records=10, archive_bytes=100)
