"""Daily trends: per-day statistics and the day's top tags and colours."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.functions import columns as X
from shutterlake.operators.tags import tag_links


def daily_stats(stg: DataFrame) -> DataFrame:
    """Per creation day: counts, totals, means, photographers and orientations."""

    def mean(name):
        return F.round(F.avg(name), 2)

    return stg.groupBy(F.to_date("created_at").alias("trend_date")).agg(
        F.count("*").alias("total_photos"),
        F.sum("likes").alias("total_likes"),
        F.sum("downloads").alias("total_downloads"),
        F.sum("views").alias("total_views"),
        mean("likes").alias("avg_likes_per_photo"),
        mean("downloads").alias("avg_downloads_per_photo"),
        mean("views").alias("avg_views_per_photo"),
        mean("like_rate").alias("avg_like_rate"),
        mean("download_rate").alias("avg_download_rate"),
        F.countDistinct("user_id").alias("unique_photographers"),
        mean("aspect_ratio").alias("avg_aspect_ratio"),
        F.count_if(F.col("orientation") == "landscape").alias("landscape_photos"),
        F.count_if(F.col("orientation") == "portrait").alias("portrait_photos"),
        F.count_if(F.col("orientation") == "square").alias("square_photos"),
    )


def _top(counts: DataFrame, value: str, top: int) -> DataFrame:
    """The ``top`` most frequent values of each day; ties go to the smaller value."""
    order = Window.partitionBy("trend_date").orderBy(F.desc("count"), value)
    return counts.withColumn("position", F.row_number().over(order)).where(
        F.col("position") <= top
    )


def daily_top_tags(bags: DataFrame, top: int = 10) -> DataFrame:
    """(trend_date, tag, count, position): the day's tags by number of occurrences."""
    counts = tag_links(bags).groupBy(F.to_date("created_at").alias("trend_date"), "tag").agg(
        F.sum("n").alias("count")
    )
    return _top(counts, "tag", top)


def daily_top_colors(photos: DataFrame, top: int = 10) -> DataFrame:
    """(trend_date, color, count, position): the day's colours by number of photos."""
    counts = (
        photos.where(F.col("color").isNotNull())
        .groupBy(F.to_date("created_at").alias("trend_date"), "color")
        .agg(F.count("*").alias("count"))
    )
    return _top(counts, "color", top)


def nested(ranked: DataFrame, value: str, name: str) -> DataFrame:
    """The ranked rows of a day as one array of {value, count}, most frequent first."""
    rows = F.sort_array(F.collect_list(F.struct("position", value, "count")))
    return ranked.groupBy("trend_date").agg(
        F.transform(rows, lambda r: F.struct(r[value].alias(value), r["count"].alias("count")))
        .alias(name)
    )


def mart_daily_trends(stg: DataFrame, bags: DataFrame, top: int = 10) -> DataFrame:
    """Daily statistics with the day's top tags and colours, newest day first."""
    return (
        daily_stats(stg)
        .join(nested(daily_top_tags(bags, top), "tag", "top_tags"), "trend_date", "left")
        .join(nested(daily_top_colors(stg, top), "color", "top_colors"), "trend_date", "left")
        .orderBy(F.desc("trend_date"))
    )


def daily_trends(
    photos: DataFrame, bags: DataFrame, day: dt.date | str | None = None, top: int = 10
) -> DataFrame:
    """The daily trend row of one day, or of every day when ``day`` is None.

    A day without photos gives no row. The day filter reaches the scan as a range.
    """
    if day is not None:
        photos = photos.where(F.to_date("created_at") == X.day(day))
        bags = bags.where(F.to_date("created_at") == X.day(day))
    count, likes, downloads = F.count("*"), F.sum("likes"), F.sum("downloads")
    stats = photos.groupBy(F.to_date("created_at").alias("trend_date")).agg(
        count.alias("total_photos"),
        X.or_zero(likes).alias("total_likes"),
        X.or_zero(downloads).alias("total_downloads"),
        X.or_zero(F.sum("views")).alias("total_views"),
        X.mean_decimal(X.or_zero(likes), count).alias("avg_likes_per_photo"),
        X.mean_decimal(X.or_zero(downloads), count).alias("avg_downloads_per_photo"),
    )
    tags = nested(daily_top_tags(bags, top), "tag", "top_tags")
    colors = nested(daily_top_colors(photos, top), "color", "top_colors")
    joined = stats.join(tags, "trend_date", "left").join(colors, "trend_date", "left")
    empty = F.array()
    return joined.withColumns(
        {c: F.coalesce(c, empty) for c in ("top_tags", "top_colors")}
    )
