"""Photographer statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.functions import columns as X

# Weights of mean likes and mean downloads in the engagement score.
LIKE_WEIGHT, DOWNLOAD_WEIGHT = 0.4, 0.6
PERSON = ("user_id", "user_username", "user_name")
ORIENTATIONS = ("landscape", "portrait", "square")  # alphabetical: ties go to the first


def photographer_metrics(stg: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Per photographer: totals, means, favourite shape and tag, recency, engagement score.

    Sums are first taken per (photographer, primary tag). That splits a photographer who owns
    a large part of the photos, and turns both modes into plain counters: three for the
    orientation, and the sub-group sizes for the tag.
    """
    measures = ("likes", "downloads", "views", "like_rate", "download_rate", "aspect_ratio")
    recent = F.col("created_at") >= F.date_sub(X.day(as_of), X.RECENT_DAYS)
    partial = (
        stg.where(F.col("user_id").isNotNull())
        .groupBy(*PERSON, "primary_tag")
        .agg(
            F.count("*").alias("photos"),
            *[F.sum(m).alias(f"{m}_sum") for m in measures],
            *[F.count(m).alias(f"{m}_n") for m in measures],
            *[F.count_if(F.col("orientation") == o).alias(o) for o in ORIENTATIONS],
            F.count_if(recent).alias("recent"),
            F.min("created_at").alias("first"),
            F.max("created_at").alias("latest"),
        )
    )

    def total(name):
        return F.sum(f"{name}_sum")

    def mean(name):
        return F.try_divide(total(name).cast("double"), F.sum(f"{name}_n"))

    most = F.greatest(*[F.sum(o) for o in ORIENTATIONS])
    shape = F.coalesce(*[F.when(F.sum(o) == most, o) for o in ORIENTATIONS])
    tag_size = F.when(
        F.col("primary_tag").isNotNull(), F.struct(-F.col("photos"), F.col("primary_tag"))
    )
    views = F.when(mean("views") > 0, mean("views")).otherwise(F.lit(1.0))
    interest = mean("likes") * LIKE_WEIGHT + mean("downloads") * DOWNLOAD_WEIGHT
    score = interest / views * 100
    return (
        partial.groupBy(*PERSON)
        .agg(
            F.sum("photos").alias("total_photos"),
            total("likes").alias("total_likes"),
            total("downloads").alias("total_downloads"),
            total("views").alias("total_views"),
            F.round(mean("likes"), 2).alias("avg_likes_per_photo"),
            F.round(mean("downloads"), 2).alias("avg_downloads_per_photo"),
            F.round(mean("views"), 2).alias("avg_views_per_photo"),
            F.round(mean("like_rate"), 2).alias("avg_like_rate"),
            F.round(mean("download_rate"), 2).alias("avg_download_rate"),
            F.round(mean("aspect_ratio"), 2).alias("avg_aspect_ratio"),
            shape.alias("most_common_orientation"),
            F.min_by("primary_tag", tag_size).alias("most_common_tag"),
            F.min("first").alias("first_photo_date"),
            F.max("latest").alias("latest_photo_date"),
            F.sum("recent").alias("recent_photos_count"),
            F.round(score, 2).alias("engagement_score"),
        )
        .withColumn("analysis_date", X.day(as_of))
    )


def photographer_analysis(photos: DataFrame, day: dt.date | str) -> DataFrame:
    """Per photographer: count, totals, decimal means; one row per user_id.

    Where a user_id occurs with several names, the group with the most photos stands for it,
    then the smallest username and full name.
    """
    count, likes, downloads = F.count("*"), F.sum("likes"), F.sum("downloads")
    grouped = (
        photos.where(F.col("user_id").isNotNull())
        .groupBy(
            "user_id",
            F.col("user_username").alias("username"),
            F.col("user_name").alias("full_name"),
        )
        .agg(
            count.alias("total_photos"),
            X.or_zero(likes).alias("total_likes"),
            X.or_zero(downloads).alias("total_downloads"),
            X.mean_decimal(X.or_zero(likes), count).alias("avg_likes_per_photo"),
            X.mean_decimal(X.or_zero(downloads), count).alias("avg_downloads_per_photo"),
        )
    )
    names = [c for c in grouped.columns if c != "user_id"]
    order = F.struct(-F.col("total_photos"), "username", "full_name")
    return (
        grouped.groupBy("user_id")
        .agg(F.min_by(F.struct(*names), order).alias("g"))
        .select("user_id", "g.*")
        .withColumn("analysis_date", X.day(day))
    )
