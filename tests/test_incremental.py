import datetime as dt
import decimal
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shutterlake.operators import cells, cooccurrence, ranking, tags
from shutterlake.plans import elt, incremental
from shutterlake.sources import search_index, tables

DAY = "2024-03-01"
T0 = dt.datetime(2024, 1, 28)


def stamp(n):
    return F.lit(dt.datetime(2024, 5, 1) + dt.timedelta(days=n))


def photo(rng, i):
    when = T0 + dt.timedelta(hours=rng.randrange(24 * 9)) if i % 9 else None
    named = [rng.choice(["a", "b", "c", None, "d"]) for _ in range(rng.randrange(5))]
    return {"id": f"p{i}", "created_at": when, "likes": rng.choice([None, 3, 50]), "downloads": i,
            "views": rng.choice([0, None, 7]), "tags": named if i % 7 else None}


def full(photos):
    bags = tags.photo_bags(photos)
    return [
        tags.tag_metrics(bags, DAY), tags.tag_analysis(bags, DAY),
        cooccurrence.tag_pair_rate(bags, DAY), cooccurrence.tag_pairs_positional(bags, DAY),
    ]


def test_cells_equal_the_analyses_of_all_photos(spark, make_photos, tmp_path, monkeypatch):
    rng, root = random.Random(5), str(tmp_path)
    old = [photo(rng, i) for i in range(30)]
    new = [photo(rng, i) for i in range(20, 40)]
    new[3]["tags"] = None  # one that loses all its tags
    tables.add_changes(make_photos(*old), root, "photos", stamp(0))
    assert incremental.refresh(spark, root) == 0
    tables.add_changes(make_photos(*new), root, "photos", stamp(1))
    with monkeypatch.context() as broken:  # one that ends before it is committed
        broken.setattr(tables, "append", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.refresh(spark, root)
    assert incremental.refresh(spark, root) == 1
    assert incremental.refresh(spark, root) is None
    tag_cells, pair_cells = (
        incremental.read(spark, root, n) for n in (incremental.TAGS, incremental.PAIRS)
    )
    got = [
        cells.tag_metrics(tag_cells, DAY), cells.tag_analysis(tag_cells, DAY),
        cells.tag_pair_rate(tag_cells, pair_cells, DAY), cells.tag_pairs_positional(pair_cells, DAY),
    ]
    for found, want in zip(got, full(elt.read_photos(spark, root)), strict=True):
        assert rows(found, *want.columns) == rows(want)
    days = cells.day_bitmaps(pair_cells).groupBy("tag1", "tag2")
    days = days.agg(F.sum(F.bitmap_count("days")).alias("n")).where("tag1 < tag2")
    want = pair_cells.where("tag1 < tag2 and day is not null").groupBy("tag1", "tag2")
    assert rows(days) == rows(want.agg(F.countDistinct("day")))


def test_rates_are_added_exactly_and_rows_made_once(spark, make_photos):
    photos = make_photos(
        {"id": "1", "created_at": T0, "likes": 2**62, "views": 1, "tags": ["a", "a"]},
        {"id": "2", "created_at": T0, "likes": 1, "views": 3, "tags": ["a"]},
    )
    one = make_photos({"id": "1", "created_at": T0, "likes": 2**62, "views": 1, "tags": ["a", "a"]})
    left = cells.tag_deltas(one, photos)
    got = left.select("like_rate", "weight", "lost_first", "new_first").first()
    assert got == (decimal.Decimal("33.333333"), 1, None, T0)
    made = left._jdf.queryExecution().optimizedPlan().toString()
    assert made.count("Generate explode") == 2  # one of each version, and no join beside them
    assert "Join" not in made


def test_pruning_makes_its_bags_once(spark, make_photos):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    photos = make_photos(*[
        {"id": str(i), "created_at": T0, "tags": ["a", "b", f"t{i % 3}"]} for i in range(30)
    ])
    bags = tags.photo_bags(photos)
    want = rows(cooccurrence.pair_statistics(bags, 6))
    counted = bags.mapInArrow(count, bags.schema)
    got = cooccurrence.pair_statistics(cooccurrence.pruned(counted, 6), 6, buckets=64)
    assert rows(got) == want
    assert made.value == 30


def test_pruning_loses_no_frequent_pair(spark, make_photos):
    rng = random.Random(6)
    photos = make_photos(*[
        {"id": str(i), "created_at": T0, "likes": i,
         "tags": [f"t{int(rng.expovariate(0.2))}" for _ in range(6)] + [f"once{i}"]}
        for i in range(80)
    ])
    bags = tags.photo_bags(photos)
    want = rows(cooccurrence.pair_statistics(bags, 6))
    small = cooccurrence.pruned(bags, 6)
    assert rows(cooccurrence.pair_statistics(small, 6)) == want
    assert rows(cooccurrence.pair_statistics(bags, 6, buckets=64)) == want
    every, left = cooccurrence.tag_pairs(bags), cooccurrence.tag_pairs(small)
    assert left.count() < every.count() * 0.8
    assert cooccurrence.heavy_pairs(left, 6, 4096).count() < left.count()


@pytest.mark.parametrize("offset", [3, 40, 118, 200])
def test_selected_page(spark, monkeypatch, offset):
    monkeypatch.setattr(ranking, "NEAR", 20)
    monkeypatch.setattr(ranking, "BINS", 64)
    rng = random.Random(7)
    data = [(f"{'x' * (i % 3)}{i}", rng.choice([5, 5, 5, -(2**40), 9, rng.randrange(10**6)])) for i in range(120)]
    data += [(f"n{i}", None) for i in range(30)]
    df = spark.createDataFrame(data, "id string, likes bigint")
    order = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    page = ranking.selected_page(df, "likes", "id", 25, offset)
    assert [tuple(r) for r in page.collect()] == order[offset : offset + 25]
    assert ranking.selected_page(df.limit(0), "likes", "id", 5, 0).count() == 0


def test_search_index(spark, make_photos, tmp_path):
    root = str(tmp_path)
    first = [{"id": str(i), "description": f"Sunset number {i}", "likes": i} for i in range(40)]
    first += [{"id": "x", "description": "was a Meadow", "likes": 1}]
    second = [{"id": "x", "user_name": "50% OFF_road", "likes": 2}, {"id": "y", "alt_description": "mEAdow"}]
    search_index.add(make_photos(*first), root, stamp(0), blocks=8)
    search_index.add(make_photos(*second), root, stamp(1), blocks=8)
    photos = make_photos(*first[:-1], *second)
    for q in ("meadow", "SUNSET number 1", "set%er 7", "off_ro", "zzz", "f", "su", "0\\% o", "ber _3"):
        got = search_index.matches(spark, root, q)
        want = elt.tables.with_bucket(photos, "id", 2)
        want = [r["id"] for r in search_index.reads.search_matches(want, q).select("id").collect()]
        assert sorted(r["id"] for r in got.collect()) == sorted(want), q
    assert search_index.wanted("a%bcde\\_fgh") == ["bcd", "cde", "fgh"]
    assert search_index.candidate_blocks(spark, root, "su") is None
    assert len(search_index.candidate_blocks(spark, root, "meadow")) <= 2
    assert search_index.candidate_blocks(spark, root, "sunset zebra") == []


def test_trigrams_of_a_long_text_take_one_pass(spark):
    texts = ["", "ab", "aBc", "caf\u00e9 \U0001f600x\n\u0130 abab", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select(F.lower("t").alias("low"), search_index.trigrams("t").alias("found"))
    for low, found in df.collect():
        want = list(dict.fromkeys((low or "")[i : i + 3] for i in range(len(low or "") - 2)))
        assert found == want
    began = time.monotonic()  # counting from the start for each place takes a hundred billion steps
    long = spark.range(1).select(F.repeat(F.lit("\u00e9bcde"), 100_000).alias("t"))
    assert len(long.select(search_index.trigrams("t")).first()[0]) == 5
    assert time.monotonic() - began < 60


def test_cleanup_is_applied_once_and_names_what_refers_to_it(spark, tmp_path):
    root = str(tmp_path)
    at = lambda n: dt.datetime(2024, 1, n)
    users = [(1, "a", at(1)), (2, "a", at(3)), (3, "b", at(1)), (4, None, at(1)), (5, "a", at(2))]
    frame = spark.createDataFrame(users, "id bigint, email string, updated_at timestamp")
    tables.add_changes(frame, root, "users", stamp(0))
    links = spark.createDataFrame([(10, 1), (11, 2), (12, 5)], "link bigint, user_id bigint")
    tables.append(links, root, "links")
    when = dt.datetime(2024, 6, 1)
    kept = [(2,), (3,), (4,)]
    assert elt.cleanup_users(spark, root, when, {"links": "user_id"}) == 2
    assert rows(elt.read_users(spark, root), "id") == kept
    tables.fold(spark, root, "users", ["id"], 4, elt.USER_ORDER)
    assert rows(elt.read_users(spark, root), "id") == kept
    assert elt.cleanup_users(spark, root, when, {"links": "user_id"}) == 0
    lost = tables.read_table(spark, root, "orphaned_references")
    assert rows(lost, "table", "removed_id", "kept_id") == [("links", "1", "2"), ("links", "5", "2")]
    assert tables.read_table(spark, root, "cleanup_logs").count() == 1
    back = spark.createDataFrame([(5, "c", at(9))], frame.schema)
    tables.add_changes(back, root, "users", stamp(90))
    assert rows(elt.read_users(spark, root), "id") == sorted([*kept, (5,)])
    one = tables.read_key(spark, root, "users", ["id"], 3, elt.USER_ORDER)
    assert rows(one, "id", "email") == [(3, "b")]
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()


def test_changes_that_arrive_during_a_fold_stay(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path), "id string, v bigint"
    tables.add_changes(spark.createDataFrame([("a", 1), ("b", 1)], schema), root, "t", stamp(0))
    merge = tables.merge

    def late(*args, **kwargs):
        tables.add_changes(spark.createDataFrame([("b", 2)], schema), root, "t", stamp(1))
        return merge(*args, **kwargs)

    monkeypatch.setattr(tables, "merge", late)
    tables.fold(spark, root, "t", ["id"], 2)
    assert rows(tables.read_keyed(spark, root, "t", ["id"])) == [("a", 1), ("b", 2)]


def test_a_broken_rebuild_leaves_the_table(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(spark.range(3), "m", "table", root)
    bad = spark.range(4).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        tables.publish(bad, "m", "table", root)
    assert tables.read_table(spark, root, "m").count() == 3
    assert tables.publish(spark.range(5), "m", "table", root).count() == 5
