"""The tables behind the dashboard's charts.

Operators read the whole table. ``top_n`` restricts one to the page a dashboard shows, for callers
that ask for it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shutterlake.functions import columns as X

# Metrics the tag chart offers.
TAG_METRICS = ("total_likes", "total_downloads", "photo_count", "avg_likes", "avg_downloads")


def most_liked(photos: DataFrame, top_n: int | None) -> DataFrame:
    if top_n is None:
        return photos
    return photos.orderBy(F.desc("likes"), "id").limit(top_n)


def histogram(
    photos: DataFrame, value: str, bins: int = 20, top_n: int | None = None
) -> DataFrame:
    """Counts in ``bins`` equal-width bins between minimum and maximum, empty bins included.

    The maximum falls into the last bin; a constant column falls into the first.
    """
    rows = most_liked(photos, top_n).where(F.col(value).isNotNull())
    rows = rows.select(F.col(value).cast("double").alias("x"))
    low, high = rows.agg(F.min("x")).scalar(), rows.agg(F.max("x")).scalar()
    width = (F.col("high") - F.col("low")) / bins
    bin_of = F.when(
        F.col("high") > F.col("low"),
        F.least(F.floor((F.col("x") - F.col("low")) / width), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    counts = (
        rows.select("x", low.alias("low"), high.alias("high"))
        .select(bin_of.cast("bigint").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("photos"))
    )
    all_bins = rows.sparkSession.range(bins).select(
        F.col("id").alias("bin"), low.alias("low"), high.alias("high")
    )
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        X.or_zero("photos").alias("photos"),
    )


def color_counts(photos: DataFrame, top: int = 10, top_n: int | None = None) -> DataFrame:
    """The most frequent colours; photos without one do not count."""
    return (
        most_liked(photos, top_n)
        .where(F.col("color").isNotNull())
        .groupBy("color")
        .agg(F.count("*").alias("photos"))
        .orderBy(F.desc("photos"), "color")
        .limit(top)
    )


def top_photos_table(photos: DataFrame, rows: int = 10) -> DataFrame:
    """The most liked photos with a shortened description."""
    return (
        photos.orderBy(F.desc("likes"), "id")
        .limit(rows)
        .select(
            X.shorten("description").alias("description"),
            "likes",
            "downloads",
            F.col("user_username").alias("photographer"),
        )
    )


def nlargest_tags(
    analysis: DataFrame, metric: str, top: int = 15, top_n: int | None = None
) -> DataFrame:
    """Top tags by ``metric`` among the ``top_n`` tags with most likes (None: among all)."""
    if metric not in TAG_METRICS:
        raise ValueError(f"metric must be one of {', '.join(TAG_METRICS)}: {metric}")
    if top_n is not None:
        analysis = analysis.orderBy(F.desc("total_likes"), "tag_name").limit(top_n)
    return analysis.orderBy(F.desc(metric), "tag_name").limit(top)


def tag_pair_labels(pairs: DataFrame, top: int = 15) -> DataFrame:
    """Labels and counts of the most frequent pairs."""
    return (
        pairs.orderBy(F.desc("cooccurrence_count"), "tag1", "tag2")
        .limit(top)
        .select(F.concat_ws(" + ", "tag1", "tag2").alias("tag_pair"), "cooccurrence_count")
    )


def daily_search_activity(trends: DataFrame, top_n: int | None = None) -> DataFrame:
    """Searches per day over the ``top_n`` strongest trend rows (None: all)."""
    if top_n is not None:
        trends = trends.orderBy(F.desc("search_count"), "search_term", "trend_date").limit(top_n)
    return trends.groupBy("trend_date").agg(F.sum("search_count").alias("search_count"))


def data_freshness(
    tables: dict[str, tuple[DataFrame, Column | str]], as_of: dt.date | str
) -> DataFrame:
    """Per table: its newest timestamp and its age in days."""
    parts = [
        df.agg(F.max(X.col(ts)).cast("timestamp_ntz").alias("newest")).select(
            F.lit(name).alias("table_name"),
            "newest",
            F.datediff(X.day(as_of), F.to_date("newest")).alias("lag_days"),
        )
        for name, (df, ts) in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def data_completeness(df: DataFrame) -> DataFrame:
    """Per column: number of NULLs and their share, from one pass over the table."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    return counts.unpivot("_rows", df.columns, "column_name", "null_count").select(
        "column_name",
        "null_count",
        F.try_divide(F.col("null_count").cast("double"), F.col("_rows")).alias("null_share"),
    )
