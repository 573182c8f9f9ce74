"""A search index: for each run of three letters the blocks of photos that hold it.

Photos lie in blocks by a hash of their id. ``photo_texts`` has what a search looks at and shows,
``photo_trigrams`` the blocks of every trigram of those texts in lower case. A search for three
or more letters reads the blocks that have all trigrams of the words it looks for, and checks
the photos in them with the same match as a scan. Loads append to both; what a photo no longer
says stays in the index, which costs a look into a block and gives no wrong answer.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake.operators import reads
from shutterlake.sources import tables

TEXTS, TRIGRAMS = "photo_texts", "photo_trigrams"
BLOCKS = 256  # of photos; a layout choice made once for each table
PARTS = 16  # of the trigram table


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text in lower case, in one pass over it.

    The text is split into characters once and bound to a lambda's variable: Spark finds a place
    in a string by counting from its start, and repeats for every element what a lambda holds.
    """

    def runs(chars):
        heads = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 2, F.lit(0)))
        return F.transform(
            heads, lambda c, i: F.concat(c, F.get(chars, i + 1), F.get(chars, i + 2))
        )

    each = F.transform(F.array(F.split(F.lower(text), "")), lambda chars: F.array_distinct(runs(chars)))
    return F.coalesce(F.get(each, F.lit(0)), F.array().cast("array<string>"))


def add(photos: DataFrame, root: str, loaded_at: Column, blocks: int = BLOCKS) -> None:
    """Indexes a load of photos: new ones, and new versions of those that are there."""
    names = [c for c in (*reads.FOUND, *reads.SEARCHED, "user_id") if c in photos.columns]
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    stamp = loaded_at.cast("timestamp").alias("loaded_at")
    rows = photos.select(*dict.fromkeys(names), block, stamp)
    where = root.rstrip("/")
    texts = rows.hint("rebalance", "block").write.mode("append").partitionBy("block")
    texts.parquet(f"{where}/{TEXTS}")
    searched = [c for c in reads.SEARCHED if c in photos.columns]
    each = F.flatten(F.array(*[trigrams(F.coalesce(c, F.lit(""))) for c in searched]))
    pairs = rows.select(F.explode(each).alias("trigram"), "block").distinct()
    part = F.pmod(F.xxhash64("trigram"), F.lit(PARTS)).cast("int")
    pairs = pairs.withColumn("part", part).hint("rebalance", "part")
    pairs.write.mode("append").partitionBy("part").parquet(f"{where}/{TRIGRAMS}")


def wanted(q: str) -> list[str]:
    """Trigrams that every match of ``q`` holds: those between its wildcards and escapes."""
    runs = re.split(r"\\.|[%_]", q.lower())
    return sorted({run[i : i + 3] for run in runs for i in range(len(run) - 2)})


def candidate_blocks(spark: SparkSession, root: str, q: str) -> list[int] | None:
    """The blocks that hold all trigrams of ``q``; None if it has none, so all must be read."""
    needed = wanted(q)
    if not needed:
        return None
    needles = spark.createDataFrame([(t,) for t in needed], "trigram string")
    part = F.pmod(F.xxhash64("trigram"), F.lit(PARTS)).cast("int")
    parts = [r[0] for r in needles.select(part).distinct().collect()]
    lists = tables.read_table(spark, root, TRIGRAMS).where(F.col("part").isin(parts))
    found = lists.where(F.col("trigram").isin(needed)).select("trigram", "block").distinct()
    both = found.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") == len(needed))
    return sorted(r["block"] for r in both.collect())  # no more than there are blocks


def matches(spark: SparkSession, root: str, q: str) -> DataFrame:
    """``reads.search_matches`` of all photos loaded, from the blocks that can hold matches.

    A ``q`` without three letters in a row has no trigram and reads all blocks.
    """
    blocks = candidate_blocks(spark, root, q)
    texts = tables.read_table(spark, root, TEXTS)
    if blocks is not None:
        texts = texts.where(F.col("block").isin(blocks))
    rest = [c for c in texts.columns if c not in ("id", "loaded_at", "block")]
    order = F.struct("loaded_at", F.xxhash64(F.to_json(F.struct(*rest))))
    photos = texts.groupBy("id").agg(F.max_by(F.struct(*rest), order).alias("p"))
    return reads.search_matches(photos.select("id", "p.*"), q)


def search_photos(
    spark: SparkSession, root: str, q: str, limit: int = 20, offset: int = 0
) -> DataFrame:
    """``reads.search_photos`` by the index."""
    return reads.search_page(matches(spark, root, q), limit, offset)
