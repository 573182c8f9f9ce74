import datetime as dt
import json

import pytest

from conftest import rows
from pyspark.sql import functions as F
from shutterlake.functions import columns as X
from shutterlake.operators import normalize
from shutterlake.sources import landing

RECORD = {
    "id": "p1", "created_at": "2024-12-15T10:00:00Z", "updated_at": "2024-12-15T12:00:00+02:00",
    "width": 3, "height": 2, "likes": 5, "user": {"id": "u", "name": "N", "username": "n"},
    "tags": [{"title": "b"}, {"title": ""}, {"title": None}, {}, {"title": "a"}, {"title": "b"}],
    "urls": {"raw": "x"}, "statistics": {"likes": {"total": 5}},
}


def write(tmp_path, *lines):
    path = tmp_path / "photos.json"
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(path)


def changed(**fields):
    record = {**RECORD, **fields}
    return {k: v for k, v in record.items() if v != "absent"}


def test_normalize(spark, tmp_path):
    bare = {k: RECORD[k] for k in ("created_at", "updated_at", "width", "height")} | {"id": "p2"}
    path = write(tmp_path, RECORD, bare)
    good, bad = normalize.split_bad(landing.read_photos(spark, path))
    assert bad.count() == 0
    one, two = normalize.normalize_photos(good).orderBy("id").collect()
    assert one["tags"] == ["b", "a", "b"] and one["urls"] == {"raw": "x"}
    assert (one["user_id"], one["user_name"], one["user_username"]) == ("u", "N", "n")
    assert one["created_at"] == one["updated_at"]
    assert two["tags"] == [] and two["urls"] == {} and two["categories"] == []
    assert two["user_id"] is None and two["likes"] is None


def test_bad_records_are_split_off(spark, tmp_path):
    path = write(
        tmp_path, RECORD, '{"id": "cut', changed(id="a", width="absent"),
        changed(id="b", width="wide"), changed(id="c", created_at="yesterday"),
        changed(id="d", height=None, width="absent"), changed(id=None),
    )
    good, bad = normalize.split_bad(landing.read_photos(spark, path))
    assert rows(good, "id") == [("p1",)]
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["created_at", "id", "malformed", "malformed", "width", "width,height"]


def test_timestamps(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T02:30:00+02:30", "2023-12-31T19:00:00-05:00",
             "2024-01-01", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.parse_ts("t").cast("string")).collect()]
    assert got == ["2024-01-01 00:00:00"] * 4 + [None, None]


def test_enrich_takes_whole_records(spark):
    schema = "id string, color string, likes bigint"
    basic = spark.createDataFrame([("1", "red", 1), ("2", "blue", 2)], schema)
    details = spark.createDataFrame([("1", None, 10)], schema)
    stats = spark.createDataFrame([("2", 7)], "id string, total bigint")
    got = rows(normalize.enrich(basic, details, stats).select(
        "id", "color", "likes", "statistics.total"))
    assert got == [("1", None, 10, None), ("2", "blue", 2, 7)]


def test_search_and_feeds(spark, tmp_path):
    page = {"results": [RECORD, changed(id="p9")], "total": 12, "total_pages": 6}
    path = write(tmp_path, page, {"results": [], "total": 0, "total_pages": 0})
    assert rows(landing.read_search(spark, path), "id", "total") == [("p1", 12), ("p9", 12)]
    cut = write(tmp_path, page, '{"results": [{"id"')
    assert rows(landing.read_search(spark, cut), "id", normalize.CORRUPT) == [
        ("p1", None), ("p9", None), (None, '{"results": [{"id"')]
    with pytest.raises(ValueError):
        landing.read_feed(spark, path, "unknown")


def test_batches(spark, tmp_path):
    records = [changed(id=str(i), created_at=f"2024-12-{i:02}T00:00:00Z", likes=-i)
               for i in range(1, 31)]
    raw = landing.read_photos(spark, write(tmp_path, *records))
    assert landing.photo_batch(raw).count() == 30
    assert landing.photo_batch(raw, batch_size=50).count() == 30
    assert rows(landing.photo_batch(raw, 2), "id") == [("29",), ("30",)]
    with_bad = landing.read_photos(spark, write(tmp_path, *records, '{"cut'))
    assert rows(landing.photo_batch(with_bad, 1), "id", "reason") == [
        ("30", None), (None, "malformed")]
    raw = landing.read_photos(spark, write(tmp_path, *records))
    assert rows(landing.photo_batch(raw, 2, order_by="popular"), "id") == [("1",), ("2",)]
    with pytest.raises(ValueError):
        landing.photo_batch(raw, 2, order_by="random")


def test_shorten_and_match(spark):
    df = spark.createDataFrame([("x" * 50,), ("y" * 51,), ("10% off",), (None,)], "t string")
    cut = [r[0] for r in df.select(X.shorten("t")).collect()]
    assert cut == ["x" * 50, "y" * 50 + "...", "10% off", None]
    assert df.where(X.matches_any("0% O", "t")).count() == 1
    assert df.where(X.matches_any("%", "t")).count() == 3
    assert df.select(F.count_if(X.matches_any("zz", "t"))).first()[0] == 0
    assert dt.date(2024, 1, 1) == spark.range(1).select(X.day("2024-01-01")).first()[0]
