"""Tag and pair statistics as sums by day, which loads add to and take from.

A cell holds the sums of one tag, or of one pair of tags, over the photos created on one day. A
photo that changes leaves the cells of its old version and enters those of its new one, so the
sums follow from the changed photos and the cells they touch. The analyses add up cells.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shutterlake.functions import columns as X
from shutterlake.operators import cooccurrence, tags

RATE = "decimal(38,12)"  # sums of rates are exact, so that what was added can be taken out
TAG_KEYS, PAIR_KEYS = ["tag", "day"], ["tag1", "tag2", "day"]
TAG_SUMS = {
    "photos": "bigint", "weight": "bigint", "likes": "bigint", "downloads": "bigint",
    "views": "bigint", "like_rate": RATE, "download_rate": RATE, "paired": "bigint",
}
RATES = tuple(c for c, t in TAG_SUMS.items() if t == RATE)
WORD = float(1 << 32)
PAIR_SUMS = {c: "bigint" for c in ("photos", "weight", "likes", "downloads", "views")}
TIMES = ("first_at", "last_at")


def _signed(old: DataFrame | None, new: DataFrame, rows) -> DataFrame:
    entering = rows(new).withColumn("sign", F.lit(1))
    return entering if old is None else entering.unionByName(rows(old).withColumn("sign", F.lit(-1)))


def _sums(names: dict[str, str]) -> list[Column]:
    return [F.sum(F.col("sign") * F.col(c)).cast(t).alias(c) for c, t in names.items()]


def _halves(rate: Column) -> dict[str, Column]:
    """A rate in millionths as two whole numbers, whose sums are exact and cost no decimals."""
    units = rate * 1e6
    high = F.floor(units / WORD)
    return {"high": high, "low": F.floor(units - high.cast("double") * WORD + 0.5)}


def _whole(name: str) -> Column:
    """The sum of rates behind the sums of their halves."""
    high, low = (F.sum(f"{name}_{half}").cast("decimal(20,0)") for half in ("high", "low"))
    units = high * F.lit(int(WORD)).cast("decimal(10,0)") + low
    return (units * F.lit("0.000001").cast("decimal(6,6)")).cast(RATE).alias(name)


def tag_rows(photos: DataFrame) -> DataFrame:
    """One row for each photo and distinct tag with what it adds to its cell."""
    bags = tags.photo_bags(photos)
    named = F.size(F.filter("bag", lambda t: t["tag"].isNotNull()))
    links = tags.tag_links(bags.withColumn("_named", named), "_named")
    n = F.col("n")

    def rate(name):
        return _halves(n * X.per_view_rate(X.or_zero(name), X.or_zero("views")))

    return links.select(
        "tag", F.to_date("created_at").alias("day"), "created_at", F.lit(1).alias("photos"),
        n.cast("bigint").alias("weight"),
        *[(n * X.or_zero(c)).alias(c) for c in ("likes", "downloads", "views")],
        *[v.alias(f"like_rate_{half}") for half, v in rate("likes").items()],
        *[v.alias(f"download_rate_{half}") for half, v in rate("downloads").items()],
        ((F.col("_named") >= 2) & F.col("tag").isNotNull()).cast("int").alias("paired"),
    )


def pair_rows(photos: DataFrame) -> DataFrame:
    """One row for each photo and pair of tags; a tag that a photo lists twice meets itself."""
    pairs = cooccurrence.tag_pairs(tags.photo_bags(photos), diagonal=True).where("weight > 0")
    return pairs.select(
        "tag1", "tag2", F.col("photo_date").alias("day"), F.lit(1).alias("photos"), "weight",
        *[(F.col("weight") * F.col(c)).alias(c) for c in cooccurrence.COUNTERS],
    )


def tag_deltas(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """What changed photos add to each tag cell, and the times that left it and came to it.

    The rows are made once: they are added up by time first, and the times of a cell then.
    """
    rows = _signed(old, new, tag_rows)
    plain = {c: t for c, t in TAG_SUMS.items() if c not in RATES}
    halves = {f"{c}_{half}": "bigint" for c in RATES for half in ("high", "low")}
    by_time = rows.groupBy(*TAG_KEYS, "created_at").agg(
        F.sum("sign").alias("s"), *_sums(plain | halves)
    )
    at = F.col("created_at")
    lost, gained = F.when(F.col("s") < 0, at), F.when(F.col("s") > 0, at)
    return by_time.groupBy(*TAG_KEYS).agg(
        *[_whole(c) if c in RATES else F.sum(c).cast(t).alias(c) for c, t in TAG_SUMS.items()],
        F.min(lost).alias("lost_first"), F.max(lost).alias("lost_last"),
        F.min(gained).alias("new_first"), F.max(gained).alias("new_last"),
    )


def pair_deltas(old: DataFrame | None, new: DataFrame) -> DataFrame:
    rows = _signed(old, new, pair_rows)
    return rows.groupBy(*PAIR_KEYS).agg(*_sums(PAIR_SUMS))


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join on keys that may be NULL."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    condition = same[0]
    for each in same[1:]:
        condition = condition & each
    return left.join(right, condition, "left").drop(*[f"_{k}" for k in keys])


def moved(deltas: DataFrame, cells: DataFrame | None, keys: list[str], sums: dict) -> DataFrame:
    """The touched cells with their new sums; ``cells`` are the stored ones, None at first.

    Of tag cells ``first_at`` and ``last_at`` follow what came. ``stale`` marks those that lost
    their first or last time: only the photos can tell the next one.
    """
    timed = "new_first" in deltas.columns
    if cells is None:
        out = deltas
        before = {c: F.lit(0) for c in sums} | {c: F.lit(None).cast("timestamp") for c in TIMES}
    else:
        kept = [*sums, *(TIMES if timed else ())]
        stored = cells.select(*keys, *[F.col(c).alias(f"old_{c}") for c in kept])
        out = _beside(deltas, stored, keys)
        before = {c: F.coalesce(f"old_{c}", F.lit(0)) for c in sums}
        before |= {c: F.col(f"old_{c}") for c in TIMES}
    values = [(F.col(c) + before[c]).cast(t).alias(c) for c, t in sums.items()]
    if timed:
        stale = (F.col("lost_first") <= before["first_at"]) | (F.col("lost_last") >= before["last_at"])
        values += [
            F.least(before["first_at"], "new_first").alias("first_at"),
            F.greatest(before["last_at"], "new_last").alias("last_at"),
            F.coalesce(stale, F.lit(False)).alias("stale"),
        ]
    return out.select(*keys, *values)


def rederived(touched: DataFrame, photos: DataFrame) -> DataFrame:
    """Tag cells whose times are stale with those of the ``photos`` of their days."""
    day = F.to_date("created_at").alias("_day")
    rows = photos.select(F.explode(F.array_distinct("tags")).alias("_tag"), day, "created_at")
    stale = touched.where("stale").select(*TAG_KEYS)
    same = F.col("tag").eqNullSafe(F.col("_tag")) & F.col("day").eqNullSafe(F.col("_day"))
    found = rows.join(stale, same).groupBy(*TAG_KEYS).agg(
        F.min("created_at").alias("true_first"), F.max("created_at").alias("true_last")
    )
    out = _beside(touched, found, TAG_KEYS)
    return out.select(
        *TAG_KEYS, *TAG_SUMS,
        F.when(F.col("stale"), F.col("true_first")).otherwise(F.col("first_at")).alias("first_at"),
        F.when(F.col("stale"), F.col("true_last")).otherwise(F.col("last_at")).alias("last_at"),
    )


# -- analyses of cells: the same rows as the operators of these names give for all photos ----


def tag_metrics(cells: DataFrame, as_of: dt.date | str, min_photos: int = 2) -> DataFrame:
    weight = F.sum("weight")
    recent = F.col("day") >= F.date_sub(X.day(as_of), X.RECENT_DAYS)
    return (
        cells.groupBy(F.col("tag").alias("tag_name"))
        .agg(
            F.sum("photos").alias("photo_count"),
            *[F.sum(c).alias(f"total_{c}") for c in ("likes", "downloads", "views")],
            *[X.mean2(F.sum(c), weight).alias(f"avg_{c}") for c in ("likes", "downloads", "views")],
            *[
                F.round((F.sum(c) / weight).cast("double"), 2).alias(f"avg_{c}")
                for c in ("like_rate", "download_rate")
            ],
            F.coalesce(F.sum(F.when(recent, F.col("photos"))), F.lit(0)).alias("recent_photos_count"),
            F.min("first_at").alias("first_photo_date"),
            F.max("last_at").alias("latest_photo_date"),
        )
        .where(F.col("photo_count") >= min_photos)
        .withColumn("analysis_date", X.day(as_of))
    )


def tag_analysis(cells: DataFrame, day: dt.date | str) -> DataFrame:
    count, likes, downloads = (F.sum(c) for c in ("weight", "likes", "downloads"))
    return (
        cells.groupBy(F.col("tag").alias("tag_name"))
        .agg(
            count.alias("photo_count"),
            likes.alias("total_likes"),
            downloads.alias("total_downloads"),
            X.mean_decimal(likes, count).alias("avg_likes"),
            X.mean_decimal(downloads, count).alias("avg_downloads"),
        )
        .withColumn("analysis_date", X.day(day))
    )


def day_bitmaps(cells: DataFrame) -> DataFrame:
    """Per pair and month, the days of its photos as a bitmap; bitmaps of a month can be merged."""
    number = F.unix_date("day")
    return cells.where("day is not null").groupBy(
        "tag1", "tag2", F.bitmap_bucket_number(number).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("days"))


def pair_statistics(cells: DataFrame, min_count: int = 2) -> DataFrame:
    """As ``cooccurrence.pair_statistics``; a cell is a day of a pair, so days are counted."""
    weight = F.sum("weight")
    totals = ("likes", "downloads", "views")
    return (
        cells.where("tag1 <> tag2")
        .groupBy("tag1", "tag2")
        .agg(
            F.sum("photos").alias("cooccurrence_count"),
            F.count("day").alias("days_appeared_together"),
            *[F.sum(c).alias(f"total_{c}") for c in totals],
            *[X.mean2(F.sum(c), weight).alias(f"avg_{c}") for c in totals],
            F.min("day").alias("first_cooccurrence_date"),
            F.max("day").alias("latest_cooccurrence_date"),
        )
        .where(F.col("cooccurrence_count") >= min_count)
    )


def tag_pair_rate(
    tag_cells: DataFrame, pair_cells: DataFrame, as_of: dt.date | str, min_count: int = 2
) -> DataFrame:
    paired = tag_cells.groupBy(F.col("tag").alias("tag1")).agg(F.sum("paired").alias("_paired"))
    rate = F.round(F.col("cooccurrence_count").cast("double") / F.col("_paired") * 100, 2)
    return (
        pair_statistics(pair_cells, min_count)
        .join(paired, "tag1")
        .withColumn("tag1_cooccurrence_rate", rate)
        .drop("_paired")
        .withColumn("analysis_date", X.day(as_of))
    )


def tag_pairs_positional(cells: DataFrame, day: dt.date | str, min_count: int = 2) -> DataFrame:
    return (
        cells.groupBy("tag1", "tag2")
        .agg(F.sum("weight").alias("cooccurrence_count"))
        .where(F.col("cooccurrence_count") >= min_count)
        .withColumn("analysis_date", X.day(day))
    )
