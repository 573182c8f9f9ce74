"""Tag statistics over tag bags.

A bag frame has one row per photo with its counters and ``bag``, its distinct tags with their
multiplicity. Duplicate tags thus cost no rows, and every operator reaches its aggregate
without a shuffle of its own before it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.functions import columns as X

PHOTO_COLUMNS = ("id", "created_at", "likes", "downloads", "views")


def photo_bags(photos: DataFrame) -> DataFrame:
    """The bags of photos that hold their tags as an array; row-local."""
    return photos.where(F.col("tags").isNotNull()).withColumn("bag", X.tag_bag("tags"))


def tag_links(bags: DataFrame, *extra: str) -> DataFrame:
    """One row per photo and distinct tag, with ``n`` = how often the photo lists the tag."""
    names = [*PHOTO_COLUMNS, *extra]
    return bags.select(*names, F.explode("bag").alias("t")).select(*names, "t.tag", "t.n")


def tag_metrics(bags: DataFrame, as_of: dt.date | str, min_photos: int = 2) -> DataFrame:
    """Per tag: distinct photos, totals, means and recent activity; rare tags dropped.

    Totals and means weigh a photo by how often it lists the tag.
    """
    n = F.col("n")
    weight = F.sum(n)

    def total(name):
        return F.sum(n * X.or_zero(name))

    def mean_rate(name):
        rate = X.per_view_rate(X.or_zero(name), X.or_zero("views"))
        return F.round(F.sum(n * rate) / weight, 2)

    recent = F.col("created_at") >= F.date_sub(X.day(as_of), X.RECENT_DAYS)
    return (
        tag_links(bags)
        .groupBy(F.col("tag").alias("tag_name"))
        .agg(
            F.count("*").alias("photo_count"),
            total("likes").alias("total_likes"),
            total("downloads").alias("total_downloads"),
            total("views").alias("total_views"),
            X.mean2(total("likes"), weight).alias("avg_likes"),
            X.mean2(total("downloads"), weight).alias("avg_downloads"),
            X.mean2(total("views"), weight).alias("avg_views"),
            mean_rate("likes").alias("avg_like_rate"),
            mean_rate("downloads").alias("avg_download_rate"),
            F.count_if(recent).alias("recent_photos_count"),
            F.min("created_at").alias("first_photo_date"),
            F.max("created_at").alias("latest_photo_date"),
        )
        .where(F.col("photo_count") >= min_photos)
        .withColumn("analysis_date", X.day(as_of))
    )


def tag_analysis(bags: DataFrame, day: dt.date | str) -> DataFrame:
    """Per tag occurrence: count, totals and decimal means; every tag is kept."""
    n = F.col("n")
    count = F.sum(n)
    likes = F.sum(n * X.or_zero("likes"))
    downloads = F.sum(n * X.or_zero("downloads"))
    return (
        tag_links(bags)
        .groupBy(F.col("tag").alias("tag_name"))
        .agg(
            count.alias("photo_count"),
            likes.alias("total_likes"),
            downloads.alias("total_downloads"),
            X.mean_decimal(likes, count).alias("avg_likes"),
            X.mean_decimal(downloads, count).alias("avg_downloads"),
        )
        .withColumn("analysis_date", X.day(day))
    )


def favorite_tags(bags: DataFrame, top: int = 10) -> DataFrame:
    """Each photographer's most used tags as (user_id, tag, uses, position)."""
    uses = (
        tag_links(bags.where(F.col("user_id").isNotNull()), "user_id")
        .groupBy("user_id", "tag")
        .agg(F.sum("n").alias("uses"))
    )
    order = Window.partitionBy("user_id").orderBy(F.desc("uses"), "tag")
    return uses.withColumn("position", F.row_number().over(order)).where(
        F.col("position") <= top
    )
