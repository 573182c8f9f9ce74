import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from conftest import rows
from pyspark.sql import functions as F
from shutterlake.operators import cooccurrence as co
from shutterlake.operators import ranking, tags

DAY = dt.date(2024, 12, 20)


@pytest.fixture(scope="module")
def photos():
    rng = random.Random(7)
    made = []
    for i in range(200):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(9))]
        # the tag "hot" is on every second photo
        made.append({
            "id": str(i), "tags": words + ["hot"] * (i % 2) if i % 20 else None,
            "created_at": dt.datetime(2024, 12, 20) - dt.timedelta(days=i % 50),
            "likes": rng.choice([None, 0, 5, 9]), "downloads": i, "views": rng.randrange(50),
        })
    return made


@pytest.fixture(scope="module")
def bags(photos, make_photos):
    return tags.photo_bags(make_photos(*photos)).cache()


def test_both_variants_on_duplicates(make_photos):
    photos = make_photos(
        {"id": "1", "created_at": dt.datetime(2024, 12, 1), "likes": 4, "views": 8,
         "tags": ["a", "a", "b"]},
        {"id": "2", "created_at": dt.datetime(2024, 11, 1), "tags": ["a"]},
    )
    bags = tags.photo_bags(photos)
    metrics = tags.tag_metrics(bags, DAY).collect()
    assert [(r["tag_name"], r["photo_count"], r["total_likes"]) for r in metrics] == [("a", 2, 8)]
    assert metrics[0]["avg_likes"] == 2.67 and metrics[0]["avg_like_rate"] == 33.33
    assert metrics[0]["recent_photos_count"] == 1
    got = rows(tags.tag_analysis(bags, DAY), "tag_name", "photo_count", "total_likes")
    assert got == [("a", 3, 8), ("b", 1, 4)]
    assert rows(co.tag_pairs_positional(bags, DAY, 1), "tag1", "tag2", "cooccurrence_count") == [
        ("a", "a", 1), ("a", "b", 2)]


def test_tag_metrics_brute_force(photos, bags):
    expected = defaultdict(list)
    for p in photos:
        for tag in p["tags"] or []:
            expected[tag].append(p)
    got = {r["tag_name"]: r for r in tags.tag_metrics(bags, DAY, 1).collect()}
    assert set(got) == set(expected)
    for tag, listed in expected.items():
        assert got[tag]["photo_count"] == len({p["id"] for p in listed})
        assert got[tag]["total_downloads"] == sum(p["downloads"] for p in listed)
        likes = [p["likes"] or 0 for p in listed]
        assert got[tag]["avg_likes"] == pytest.approx(sum(likes) / len(likes), abs=0.0051)


def test_pairs_brute_force(photos, bags):
    photo_sets, days, total, weight = defaultdict(set), defaultdict(set), Counter(), Counter()
    paired = defaultdict(set)
    for p in photos:
        for t1 in p["tags"] or []:
            for t2 in p["tags"]:
                if t1 < t2:
                    photo_sets[t1, t2].add(p["id"])
                    days[t1, t2].add(p["created_at"])
                    total[t1, t2] += p["likes"] or 0
                    weight[t1, t2] += 1
                    paired[t1].add(p["id"])
                    paired[t2].add(p["id"])
    pairs = co.tag_pair_rate(bags, DAY).collect()
    assert {(r["tag1"], r["tag2"]) for r in pairs} == {
        k for k, v in photo_sets.items() if len(v) >= 2
    }
    for r in pairs:
        key = r["tag1"], r["tag2"]
        assert r["cooccurrence_count"] == len(photo_sets[key])
        assert r["days_appeared_together"] == len(days[key])
        assert r["total_likes"] == total[key]
        assert r["avg_likes"] == pytest.approx(total[key] / weight[key], abs=0.0051)
        rate = len(photo_sets[key]) / len(paired[key[0]]) * 100
        assert r["tag1_cooccurrence_rate"] == pytest.approx(rate, abs=0.0051)


def test_positional_brute_force(photos, bags):
    expected = Counter()
    for p in photos:
        expected.update(tuple(sorted(pair)) for pair in combinations(p["tags"] or [], 2))
    got = rows(co.tag_pairs_positional(bags, DAY), "tag1", "tag2", "cooccurrence_count")
    assert got == sorted((*k, n) for k, n in expected.items() if n >= 2)


@pytest.mark.parametrize("diagonal", [False, True])
def test_chunks_of_heads_give_the_same_pairs(bags, diagonal, monkeypatch):
    names = ("id", "tag1", "tag2", "weight")
    whole = rows(co.tag_pairs(bags, diagonal), *names)
    monkeypatch.setattr(co, "HEADS", 2)
    assert rows(co.tag_pairs(bags, diagonal), *names) == whole


def test_short_lists_and_null_tags(make_photos):
    photos = make_photos({"id": "1", "tags": ["a"]}, {"id": "2", "tags": []},
                         {"id": "3", "tags": None}, {"id": "4", "tags": ["a", None]})
    bags = tags.photo_bags(photos)
    assert co.tag_pairs(bags).count() == 0
    assert rows(tags.tag_analysis(bags, DAY), "tag_name", "photo_count") == [("a", 2), (None, 1)]


def test_ranks_follow_the_orders(bags):
    found = [r.asDict() for r in co.mart_tag_cooccurrence(bags, DAY).collect()]
    for rank, value in (("popularity_rank", "cooccurrence_count"), ("engagement_rank", "avg_likes")):
        found.sort(key=lambda r: (-r[value], r["tag1"], r["tag2"]))
        assert [r[rank] for r in found] == list(range(1, len(found) + 1))


def test_rates_start_no_job(spark, bags):
    tracker, group = spark.sparkContext.statusTracker(), "rates"
    spark.sparkContext.setJobGroup(group, group)
    co.tag_pair_rate(bags, DAY)
    assert len(tracker.getJobIdsForGroup(group)) == 0
    spark.sparkContext.setJobGroup("rest", "rest")


def test_deep_page_equals_top_page(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 101).alias("v"), "id").repartition(7)
    order = [F.desc("v"), F.asc("id")]
    top = [tuple(r) for r in ranking.top_page(df, order, 20, 500).collect()]
    assert [tuple(r) for r in ranking.deep_page(df, order, 20, 500).collect()] == top
    assert ranking.deep_page(df, order, 20, 5000).count() == 0


def test_partners_and_favourites(make_photos):
    photos = make_photos(
        {"id": "1", "user_id": "u", "tags": ["a", "b", "c"]},
        {"id": "2", "user_id": "u", "tags": ["a", "b", "b"]},
        {"id": "3", "user_id": None, "tags": ["a", "c"]},
    )
    bags = tags.photo_bags(photos)
    pairs = co.tag_cooccurrence(bags, DAY, 1)
    assert rows(co.co_occurring_tags(pairs, 1), "tag_name", "partner") == [
        ("a", "b"), ("b", "a"), ("c", "a")]
    assert rows(tags.favorite_tags(bags, 2)) == [("u", "a", 2, 2), ("u", "b", 3, 1)]
