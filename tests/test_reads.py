import datetime as dt

import pytest

from conftest import rows
from pyspark.sql import functions as F
from shutterlake.operators import charts, maintenance, quality, reads, search

DAY = dt.date(2024, 12, 20)
NOON = dt.datetime(2024, 12, 20, 12)


@pytest.fixture(scope="module")
def photos(make_photos):
    return make_photos(*[
        {"id": str(i), "likes": i // 2, "downloads": 10 - i, "views": i,
         "created_at": NOON - dt.timedelta(days=i), "description": "Big SKY" if i < 3 else None,
         "user_id": str(i % 3), "user_username": "skyler" if i == 9 else "ann", "tags": ["sky"]}
        for i in range(10)
    ])


def test_list_photos(photos):
    assert [r["id"] for r in reads.list_photos(photos, "likes", 3).collect()] == ["8", "9", "6"]
    page = reads.list_photos(photos, "created_at", 2, 9)
    assert [r["id"] for r in page.collect()] == ["9"]
    assert page.columns[-2:] == ["user", "tags"]
    assert reads.list_photos(photos, limit=1, offset=99).count() == 0
    assert tuple(reads.pagination(photos, 5, 4).first()) == (10, 5, 4, True)
    assert reads.pagination(photos, 5, 5).first()["has_next"] is False


@pytest.mark.parametrize("bad", [
    {"limit": 0}, {"limit": 101}, {"offset": -1}, {"order_by": "id"}])
def test_list_limits(photos, bad):
    with pytest.raises(ValueError):
        reads.list_photos(photos, **bad)


def test_other_limits(spark):
    df = spark.range(1)
    for call in (
        lambda: reads.recent_search_trends(df, DAY, days=31),
        lambda: reads.recent_daily_trends(df, DAY, days=0),
        lambda: reads.top_tags(df, DAY, limit=101),
        lambda: reads.top_photographers(df, DAY, order_by="user_id"),
        lambda: reads.top_tag_pairs(df, DAY, limit=201),
        lambda: reads.top_tag_pairs(df, DAY, min_count=0),
        lambda: reads.search_photos(df, ""),
        lambda: charts.nlargest_tags(df, "tag_name"),
    ):
        with pytest.raises(ValueError):
            call()


def test_search(photos):
    found = reads.search_photos(photos, "sKy")
    assert [r["id"] for r in found.collect()] == ["9", "2", "0", "1"]  # tags are not searched
    assert reads.search_matches(photos, "s_y").count() == 4
    assert reads.search_matches(photos, "sky%z").count() == 0


def test_detail(spark, photos):
    stats = spark.createDataFrame(
        [("1", NOON, 1, 2, 3), ("1", NOON - dt.timedelta(1), 9, 9, 9)],
        "photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint")
    one = reads.photo_detail(photos, stats, "1").first()
    assert tuple(one["latest_statistics"]) == (1, 2, 3, NOON)
    assert one["user"]["username"] == "ann"
    assert reads.photo_detail(photos, stats, "2").first()["latest_statistics"] is None
    assert reads.photo_detail(photos, stats, "none").count() == 0
    assert reads.photo_detail(photos, stats).count() == 10


def test_overview(spark, photos):
    jobs = spark.createDataFrame(
        [("a", "completed", NOON, NOON, 1), ("b", "failed", NOON + dt.timedelta(1), None, 2)],
        "job_name string, status string, started_at timestamp, completed_at timestamp, "
        "records_processed bigint")
    got = reads.overview(photos, jobs, DAY).first()
    assert (got["total_photos"], got["total_photographers"]) == (10, 3)
    assert got["recent_photos_7_days"] == 8  # the seventh day before counts
    assert got["top_photo"]["id"] == "8" and got["latest_etl_job"]["job_name"] == "b"
    empty = reads.overview(photos.limit(0), jobs.limit(0), DAY).first()
    assert empty["total_photos"] == 0 and empty["top_photo"] is None


def test_histogram(photos):
    got = rows(charts.histogram(photos, "views", 3, None), "bin", "bin_start", "photos")
    assert got == [(0, 0.0, 3), (1, 3.0, 3), (2, 6.0, 4)]
    flat = charts.histogram(photos.withColumn("views", F.lit(4)), "views", 2, None)
    assert rows(flat, "bin", "photos") == [(0, 10), (1, 0)]
    assert sum(r[0] for r in rows(charts.histogram(photos, "views", top_n=4), "photos")) == 4


def test_freshness_and_completeness(photos):
    got = charts.data_freshness({"photos": (photos, "created_at")}, "2024-12-25").first()
    assert got["lag_days"] == 5
    shares = {r[0]: r[1:] for r in rows(charts.data_completeness(photos))}
    assert shares["id"] == (0, 0.0) and shares["description"] == (7, 0.7)


def test_search_trends(spark):
    log = spark.createDataFrame([("sun", NOON), ("sun", NOON), ("sea", NOON)],
                                "q string, t timestamp")
    trends = search.search_trends(log, "q", "t")
    assert rows(trends, "search_term", "search_count") == [("sea", 1), ("sun", 2)]
    recent = reads.recent_search_trends(trends, DAY, 1, 1).collect()
    assert [r["search_term"] for r in recent] == ["sun"]
    assert rows(charts.daily_search_activity(trends, 1)) == [(DAY, 2)]


# -- maintenance and quality ---------------------------------------------------------------


@pytest.fixture(scope="module")
def users(spark):
    data = [("u1", "a", NOON), ("u2", "a", NOON + dt.timedelta(1)), ("u3", "a", NOON),
            ("u4", "b", NOON)]
    return spark.createDataFrame(data, "id string, email string, updated_at timestamp")


def test_dedup(users):
    assert rows(maintenance.dedup_latest(users), "id") == [("u2",), ("u4",)]
    log = rows(maintenance.dedup_log(users), "details", "affected_records")
    assert log == [("Cleaned up duplicate users for email a. Kept ID: u2, Removed IDs: u1, u3", 2)]


def test_removed_rows_equal_logged_rows(spark):
    many = spark.range(500).select(
        F.col("id"),
        F.when(F.col("id") % 5 == 0, None).when(F.col("id") < 400, "hot").otherwise("cold")
        .alias("email"),
        F.timestamp_seconds(F.col("id") % 100).alias("updated_at"),
    )
    many = many.unionByName(many.where("id in (7, 8)"))  # rows alike
    kept = maintenance.dedup_latest(many)
    assert kept.where("email is null").count() == 100
    removed = maintenance.dedup_removed(many)
    assert kept.count() + removed.count() == many.count()
    counts = rows(maintenance.dedup_counts(many), "email", "kept_id", "affected_records")
    assert counts == rows(removed.groupBy("email", "kept_id").count(), "email", "kept_id", "count")
    named = [
        int(x)
        for r in maintenance.dedup_log(many).collect()
        for x in r["details"].split("Removed IDs: ")[1].split(", ")
    ]
    assert sorted(named) == sorted(r["removed_id"] for r in removed.collect())


def test_cleanup_summary_and_filter(spark, users):
    logs = spark.createDataFrame([("x", 2, NOON), ("x", 3, NOON + dt.timedelta(1))],
                                 "operation string, affected_records bigint, created_at timestamp")
    assert rows(maintenance.cleanup_summary(logs)) == [
        ("x", 2, 5, NOON, NOON + dt.timedelta(1))]
    assert rows(maintenance.row_filter(users, "email", "b"), "id") == [("u4",)]


def test_evolve(users):
    new = maintenance.evolve(users, {"score": "double", "email": "string"},
                             {"score": F.lit(1.0)})
    assert new.columns == ["id", "email", "updated_at", "score"]
    assert rows(new.select("score").distinct()) == [(1.0,)]
    assert maintenance.missing_columns(users, ["id", "score"]) == ["score"]


def test_checks(spark, users):
    assert rows(quality.check_unique(users, ["email"])) == [("a", 3)]
    assert quality.check_unique(users, ["id"]).count() == 0
    holes = users.withColumn("email", F.nullif("email", F.lit("b")))
    assert rows(quality.check_not_null(holes, ["id", "email"])) == [("email", 1)]
    parent = spark.createDataFrame([("a",)], "k string")
    assert rows(quality.check_foreign_key(users, "email", parent, "k")) == [("b", 1)]
    assert rows(quality.orphans(users, "email", parent, "k"), "id") == [("u4",)]
