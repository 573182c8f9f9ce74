"""Tags that appear together on photos.

Input is a bag frame. Pairs are generated from the bag row by row, each distinct pair of a
photo once with a weight, and meet only in the map-side combine of the aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.functions import columns as X
from shutterlake.operators import ranking
from shutterlake.session import checkpointed

COUNTERS = ("likes", "downloads", "views")
PHOTO_COLUMNS = ("id", "photo_date", *COUNTERS)
# First tags of the pairs that one row makes; a photo gives a row for each so many of its tags.
HEADS = 256


def _tagged():
    return F.filter("bag", lambda t: t["tag"].isNotNull())


def _named(bags: DataFrame) -> DataFrame:
    """Bags without NULL tags, counters defaulted, and the creation day."""
    return bags.select(
        "id",
        F.to_date("created_at").alias("photo_date"),
        *[X.or_zero(c).alias(c) for c in COUNTERS],
        _tagged().alias("bag"),
    )


def tag_pairs(bags: DataFrame, diagonal: bool = False) -> DataFrame:
    """One row per photo and distinct tag pair, ``tag1 < tag2``, with its ``weight``.

    The weight is the number of position pairs behind the row: the product of the two
    multiplicities, or n(n-1)/2 on the ``diagonal``, where a tag meets itself. Every list is cut
    into chunks of ``HEADS`` first tags, which are spread by photo and chunk, so that many tasks
    make the pairs of a long list.
    """
    first = 0 if diagonal else 1
    last = F.ceil(F.size("bag") / HEADS) - 1
    chunks = F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last))
    rows = _named(bags).withColumn("chunk", F.explode(chunks)).repartition("id", "chunk")
    start = (F.col("chunk") * HEADS + 1).cast("int")
    heads = rows.select(
        *PHOTO_COLUMNS,
        "bag",
        start.alias("start"),
        F.posexplode(F.slice("bag", start, HEADS)).alias("i", "a"),
    )
    rest = F.slice("bag", F.col("start") + F.col("i") + first, F.size("bag"))
    pairs = heads.select(*PHOTO_COLUMNS, "a", F.explode(rest).alias("b"))
    n = F.col("a.n")
    weight = n * F.col("b.n")
    if diagonal:
        own = F.col("a.tag") == F.col("b.tag")
        weight = F.when(own, (n * (n - 1) / 2).cast("bigint")).otherwise(weight)
    return pairs.select(
        *PHOTO_COLUMNS,
        F.col("a.tag").alias("tag1"),
        F.col("b.tag").alias("tag2"),
        weight.alias("weight"),
    )


def pruned(bags: DataFrame, min_count: int) -> DataFrame:
    """Bags without the tags that are on fewer than ``min_count`` photos.

    A pair is on no more photos than either of its tags, so no pair that frequent is lost, and
    the pairs of a long tail of tags are never made. Costs two shuffles of (photo, tag) rows. The
    bags are read three times, so they are written once.
    """
    bags = checkpointed(bags)
    links = bags.select("id", F.explode(_tagged()).alias("t")).select("id", "t.tag", "t.n")
    often = links.groupBy("tag").agg(F.count("*").alias("_photos"))
    often = often.where(F.col("_photos") >= min_count).select("tag")
    kept = links.join(often, "tag", "left_semi").groupBy("id")
    kept = kept.agg(F.array_sort(F.collect_list(F.struct("tag", "n"))).alias("bag"))
    names = [c for c in bags.columns if c != "bag"]
    return bags.select(*names).join(kept, "id").select(*names, "bag")


def heavy_pairs(pairs: DataFrame, min_count: int, buckets: int) -> DataFrame:
    """The rows of pairs whose hash bucket holds ``min_count`` rows or more.

    A pair's bucket holds at least its own rows, so no pair that frequent is lost. The heavy
    buckets are ``buckets`` numbers at most, which bounds what is broadcast; rows of light ones
    go before the shuffle of the pairs. Choose more buckets than there are frequent pairs.
    """
    bucket = F.pmod(F.xxhash64("tag1", "tag2"), F.lit(buckets))
    heavy = pairs.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    heavy = heavy.where(F.col("_rows") >= min_count).select("_bucket")
    named = pairs.withColumn("_bucket", bucket)
    return named.join(F.broadcast(heavy), "_bucket", "left_semi").drop("_bucket")


def pair_statistics(
    bags: DataFrame, min_count: int = 2, buckets: int | None = None
) -> DataFrame:
    """Statistics per pair of tags that share a photo.

    Totals and means are over position pairs, hence the weights. The distinct days make Spark
    aggregate by (pair, day) first, which also splits a pair that is on most photos. With
    ``buckets`` the pairs are made twice, and those in light buckets are not shuffled.
    """
    if buckets:  # the bags are read twice, so they are written once
        pairs = heavy_pairs(tag_pairs(checkpointed(bags)), min_count, buckets)
    else:
        pairs = tag_pairs(bags)
    weight = F.sum("weight")

    def total(name):
        return F.sum(F.col("weight") * F.col(name))

    return (
        pairs.groupBy("tag1", "tag2")
        .agg(
            F.count("*").alias("cooccurrence_count"),
            F.countDistinct("photo_date").alias("days_appeared_together"),
            total("likes").alias("total_likes"),
            total("downloads").alias("total_downloads"),
            total("views").alias("total_views"),
            X.mean2(total("likes"), weight).alias("avg_likes"),
            X.mean2(total("downloads"), weight).alias("avg_downloads"),
            X.mean2(total("views"), weight).alias("avg_views"),
            F.min("photo_date").alias("first_cooccurrence_date"),
            F.max("photo_date").alias("latest_cooccurrence_date"),
        )
        .where(F.col("cooccurrence_count") >= min_count)
    )


def tag_cooccurrence(
    bags: DataFrame, as_of: dt.date | str, min_count: int = 2, buckets: int | None = None
) -> DataFrame:
    """Per pair: distinct photos and days, totals, means, first and last date."""
    pairs = pair_statistics(bags, min_count, buckets)
    return pairs.withColumn("analysis_date", X.day(as_of))


def paired_photos(bags: DataFrame) -> DataFrame:
    """Per tag: the photos on which it stands beside another tag. One row for each tag of a
    photo, combined before the shuffle."""
    return (
        bags.select(_tagged().alias("bag"))
        .where(F.size("bag") >= 2)
        .select(F.explode("bag.tag").alias("tag"))
        .groupBy("tag")
        .agg(F.count("*").alias("_paired"))
    )


def tag_pair_rate(bags: DataFrame, as_of: dt.date | str, min_count: int = 2) -> DataFrame:
    """The pairs with the share of tag1's paired photos that also carry tag2, in percent."""
    rate = F.round(F.col("cooccurrence_count").cast("double") / F.col("_paired") * 100, 2)
    return (
        pair_statistics(bags, min_count)
        .join(paired_photos(bags).withColumnRenamed("tag", "tag1"), "tag1")
        .withColumn("tag1_cooccurrence_rate", rate)
        .drop("_paired")
        .withColumn("analysis_date", X.day(as_of))
    )


def mart_tag_cooccurrence(
    bags: DataFrame, as_of: dt.date | str, min_count: int = 2
) -> DataFrame:
    """Pairs with rates and the two global ranks, most frequent first; ranked by ranges."""
    pairs = checkpointed(tag_pair_rate(bags, as_of, min_count))
    by_count = [F.desc("cooccurrence_count"), F.asc("tag1"), F.asc("tag2")]
    by_likes = [F.desc("avg_likes"), F.asc("tag1"), F.asc("tag2")]
    key = ["tag1", "tag2"]
    # only the pair and its measure are sorted
    liked = ranking.rank_by_ranges(pairs.select(*key, "avg_likes"), by_likes, "engagement_rank")
    counted = pairs.select(*key, "cooccurrence_count")
    counted = ranking.rank_by_ranges(counted, by_count, "popularity_rank")
    ranks = liked.drop("avg_likes").join(counted.drop("cooccurrence_count"), key)
    return pairs.join(ranks, key).orderBy("popularity_rank")


def tag_pairs_positional(
    bags: DataFrame, day: dt.date | str, min_count: int = 2
) -> DataFrame:
    """Pairs over list positions i < j: duplicates count, and a tag can pair with itself."""
    return (
        tag_pairs(bags, diagonal=True)
        .groupBy("tag1", "tag2")
        .agg(F.sum("weight").alias("cooccurrence_count"))
        .where(F.col("cooccurrence_count") >= min_count)
        .withColumn("analysis_date", X.day(day))
    )


def co_occurring_tags(pairs: DataFrame, top: int = 10) -> DataFrame:
    """Each tag's most frequent partners as (tag_name, partner, count, position)."""
    ends = F.array(
        F.struct(F.col("tag1").alias("tag_name"), F.col("tag2").alias("partner")),
        F.struct(F.col("tag2").alias("tag_name"), F.col("tag1").alias("partner")),
    )
    mirrored = (
        pairs.where("tag1 <> tag2")
        .select(F.explode(ends).alias("e"), "cooccurrence_count")
        .select("e.*", "cooccurrence_count")
    )
    order = Window.partitionBy("tag_name").orderBy(F.desc("cooccurrence_count"), "partner")
    return mirrored.withColumn("position", F.row_number().over(order)).where(
        F.col("position") <= top
    )
