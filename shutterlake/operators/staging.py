"""Staging projection of the photos table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shutterlake.functions import columns as X

COUNTERS = ("downloads", "likes", "views")


def stg_photos(
    photos: DataFrame, as_of: dt.date | str, primary_tag: Column | str | None = None
) -> DataFrame:
    """Photos with counters defaulted to 0 and the derived shape, rate and age columns.

    The rates read the raw counters: a missing counter gives a NULL rate, which averages
    skip. ``primary_tag`` defaults to the first element of ``tags``.
    """
    primary_tag = X.first_tag("tags") if primary_tag is None else X.col(primary_tag)
    kept = [X.or_zero(c).alias(c) if c in COUNTERS else F.col(c) for c in photos.columns]
    return photos.select(
        *kept,
        X.aspect_ratio().alias("aspect_ratio"),
        X.orientation().alias("orientation"),
        X.per_view_rate("likes").alias("like_rate"),
        X.per_view_rate("downloads").alias("download_rate"),
        F.datediff(X.day(as_of), F.to_date("created_at")).alias("days_since_created"),
        primary_tag.alias("primary_tag"),
    )
