"""Filtered, paged and top-k reads. Sorts are descending, with the key as tie-breaker."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.functions import columns as X
from shutterlake.operators.ranking import deep_page, selected_page, top_page
from shutterlake.operators.snapshots import DELTAS, latest_snapshots

# Columns a caller may sort by.
PHOTO_ORDERS = ("created_at", "likes", "downloads", "views")
PHOTOGRAPHER_ORDERS = (
    "total_likes",
    "total_downloads",
    "total_photos",
    "avg_likes_per_photo",
)
# Fields of a listed and of a found photo, and the fields a search looks at.
LISTED = (
    "id",
    "description",
    "alt_description",
    "width",
    "height",
    "color",
    "likes",
    "downloads",
    "views",
    "created_at",
    "urls",
    "user",
    "tags",
)
FOUND = ("id", "description", "alt_description", "likes", "downloads", "urls", "user", "tags")
SEARCHED = ("description", "alt_description", "user_username", "user_name")


def _check_range(name: str, value: int, low: int, high: int | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be {low}..{high if high is not None else ''}: {value}")


def _check_choice(name: str, value: str, choices: tuple[str, ...]) -> None:
    if value not in choices:
        raise ValueError(f"{name} must be one of {', '.join(choices)}: {value}")


def _with_user(photos: DataFrame) -> DataFrame:
    fields = {"user_id": "id", "user_username": "username", "user_name": "name"}
    present = [c for c in fields if c in photos.columns]
    user = F.struct(*[F.col(c).alias(fields[c]) for c in present])
    return photos.withColumn("user", user).drop(*present)


def _only(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.select(*[c for c in names if c in df.columns])


def photo_count(photos: DataFrame) -> DataFrame:
    return photos.agg(F.count("id").alias("total_photos"))


def pagination(photos: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """One row: total, limit, offset, has_next."""
    return photos.agg(F.count("id").alias("total")).select(
        "total",
        F.lit(limit).alias("limit"),
        F.lit(offset).alias("offset"),
        (F.lit(offset + limit) < F.col("total")).alias("has_next"),
    )


def list_photos(
    photos: DataFrame, order_by: str = "created_at", limit: int = 20, offset: int = 0
) -> DataFrame:
    """One page of photos near the beginning; ``pagination`` gives its totals."""
    return top_page(*_listed(photos, order_by, limit, offset))


def list_photos_deep(
    photos: DataFrame, order_by: str = "created_at", limit: int = 20, offset: int = 0
) -> DataFrame:
    """The same page for an offset anywhere in the table."""
    return deep_page(*_listed(photos, order_by, limit, offset))


def list_photos_selected(
    photos: DataFrame, order_by: str = "created_at", limit: int = 20, offset: int = 0
) -> DataFrame:
    """The same page, found by counting instead of sorting; runs a few scans when called."""
    rows, _, limit, offset = _listed(photos, order_by, limit, offset)
    return selected_page(rows, order_by, "id", limit, offset)


def _listed(photos, order_by, limit, offset):
    _check_choice("order_by", order_by, PHOTO_ORDERS)
    _check_range("limit", limit, 1, 100)
    _check_range("offset", offset, 0)
    rows = _only(_with_user(photos), LISTED)
    return rows, [F.desc(order_by), F.asc("id")], limit, offset


def photo_detail(
    photos: DataFrame, statistics: DataFrame, photo_id: str | None = None, tie: str | None = None
) -> DataFrame:
    """A photo, or every photo, with its latest statistics (NULL if it has none)."""
    if photo_id is not None:
        photos = photos.where(F.col("id") == photo_id)
        statistics = statistics.where(F.col("photo_id") == photo_id)
    totals = F.struct(*DELTAS, "recorded_at").alias("latest_statistics")
    newest = latest_snapshots(statistics, tie).select(F.col("photo_id").alias("id"), totals)
    return _with_user(photos.join(newest, "id", "left"))


def recent_search_trends(
    trends: DataFrame, as_of: dt.date | str, days: int = 7, limit: int = 20
) -> DataFrame:
    _check_range("days", days, 1, 30)
    _check_range("limit", limit, 1, 100)
    return (
        trends.where(F.col("trend_date") >= F.date_sub(X.day(as_of), days))
        .select("search_term", "search_count", "trend_date", "category")
        .orderBy(F.desc("search_count"), "search_term", "trend_date")
        .limit(limit)
    )


def top_tags(analysis: DataFrame, day: dt.date | str, limit: int = 20) -> DataFrame:
    _check_range("limit", limit, 1, 100)
    return (
        analysis.where(F.col("analysis_date") == X.day(day))
        .orderBy(F.desc("total_likes"), "tag_name")
        .limit(limit)
    )


def top_photographers(
    analysis: DataFrame, day: dt.date | str, order_by: str = "total_likes", limit: int = 20
) -> DataFrame:
    _check_choice("order_by", order_by, PHOTOGRAPHER_ORDERS)
    _check_range("limit", limit, 1, 100)
    return (
        analysis.where(F.col("analysis_date") == X.day(day))
        .orderBy(F.desc(order_by), "user_id")
        .limit(limit)
    )


def recent_daily_trends(trends: DataFrame, as_of: dt.date | str, days: int = 30) -> DataFrame:
    """The daily trends since ``days`` before ``as_of``, newest first."""
    _check_range("days", days, 1, 365)
    return trends.where(F.col("trend_date") >= F.date_sub(X.day(as_of), days)).orderBy(
        F.desc("trend_date")
    )


def top_tag_pairs(
    pairs: DataFrame, day: dt.date | str, min_count: int = 2, limit: int = 50
) -> DataFrame:
    _check_range("min_count", min_count, 1)
    _check_range("limit", limit, 1, 200)
    return (
        pairs.where(
            (F.col("analysis_date") == X.day(day)) & (F.col("cooccurrence_count") >= min_count)
        )
        .orderBy(F.desc("cooccurrence_count"), "tag1", "tag2")
        .limit(limit)
    )


def overview(photos: DataFrame, jobs: DataFrame, as_of: dt.date | str) -> DataFrame:
    """One row: photo and photographer counts, last week's photos, top photo, latest job."""
    week = F.to_date("created_at") >= F.date_sub(X.day(as_of), 7)
    job = jobs.orderBy(F.desc("started_at"), "job_name").limit(1)
    top_fields = [c for c in ("id", "description", "likes", "downloads", "user_username")
                  if c in photos.columns]
    job_fields = ["job_name", "status", "started_at", "completed_at", "records_processed"]
    first = F.struct((-X.or_zero("likes")).alias("_order"), F.col("id").alias("_id"))
    return photos.agg(
        F.count("id").alias("total_photos"),
        F.countDistinct("user_id").alias("total_photographers"),
        F.count_if(week).alias("recent_photos_7_days"),
        F.min_by(F.struct(*top_fields), first).alias("top_photo"),
    ).select(
        "*",
        job.select(F.struct(*job_fields)).scalar().alias("latest_etl_job"),
    )


def search_matches(photos: DataFrame, q: str) -> DataFrame:
    """Photos whose description, alternative description, username or name contains ``q``."""
    if not q:
        raise ValueError("q must not be empty")
    return photos.where(X.matches_any(q, *[c for c in SEARCHED if c in photos.columns]))


def search_photos(photos: DataFrame, q: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """One page of the matching photos, most liked first."""
    return search_page(search_matches(photos, q), limit, offset)


def search_page(matches: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    _check_range("limit", limit, 1, 100)
    _check_range("offset", offset, 0)
    rows = _only(_with_user(matches.drop("user_id")), FOUND)
    return top_page(rows, [F.desc("likes"), F.asc("id")], limit, offset)
