"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm.common import checkpointed

MAX_ROUNDS = 100


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node reachable.

    Every round hangs a node's larger neighbours, then its smaller ones, on its smallest
    neighbour; the links end as one star for each component. Only minima are aggregated, so a
    node with very many links is combined before the shuffle, and the join back is one that
    Spark can split. Loops, repeated links and links with a NULL end are ignored. The number of
    rounds grows with the logarithm of the longest path. Every round is checkpointed.
    """
    star = checkpointed(
        links.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = _signature(star)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        star = checkpointed(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, state = state, _signature(star)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _signature(star: DataFrame) -> tuple:
    row = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
