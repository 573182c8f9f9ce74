"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shutterlake.llm import ordering, vectors
from shutterlake.llm.common import checkpointed, materialized
from shutterlake.llm.components import connected_components

BLOCK = 4096  # rows of a pass that one task compares
ROWS = 256  # of these compared at once
CHUNK = 1024  # vectors of a component that meet another chunk in one task


def near_duplicates(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    passes: int = 10,
    bits: int = 48,
    window: int = 1024,
    seed: int = 11,
    miss: float = 1e-3,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``df``.

    Vectors are ordered ``passes`` times, or as often as ``passes_for`` derives from the number
    of classes if that is more, each time lexicographically by ``bits`` concatenated
    random hashes (the side of a random plane). A vector is compared with its ``window``
    successors in every order; pairs with a cosine of ``threshold`` or more, in double
    precision, are links, and the union of all passes gives the components. A task passes on
    one link for each vector, to the first one it is connected with there. The members of a component then
    count their links among each other exactly, so a group larger than any window loses none:
    a component is dealt in chunks and every two chunks meet in one task, which returns counts
    and no pairs.

    Equal vectors are one class: they are compared once and counted with their number. Ids need
    not be unique: rows with one id and different vectors are classes of their own. A pair
    at the threshold that no third vector connects is lost with a chance of ``miss`` at most,
    at every size, if the planes deal the vectors evenly; where vectors crowd in a few
    directions, the chance is that of a larger table.

    Rows whose vector is null, empty, zero or has a null or non-finite component, and rows
    without an id, link with nothing: no links, their own component. Vectors of unequal
    length do not link. Repeated rows are copies and link with each other. Other columns are
    not read.
    """
    rows = vectors.members(df, id_column, vector)
    groups = vectors.classes(rows, "vector-classes")
    width = vectors.dimension(groups)
    passes = max(passes, passes_for(groups.count(), threshold, window, miss))
    links = _window_links(groups, width, threshold, passes, bits, window, seed)
    roots = connected_components(links).withColumnsRenamed({"node": "number"})
    linked = checkpointed(groups.join(roots, "number"))
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    counts = _links_within(linked.select("number", "size", "vector", "root"), width, threshold)
    found = (
        groups.join(roots.join(least, "root").drop("root"), "number", "left")
        .join(counts, "number", "left")
        .select(
            F.xxhash64("vector").alias("hash"),  # cheaper to sort than vectors
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("least", "rep").alias("component_id"),
        )
    )
    taking = vectors.usable(vector) & F.col(id_column).isNotNull()
    keyed = df.select(
        F.col(id_column).alias("_id"), F.when(taking, F.col(vector)).alias("_vector")
    )
    keyed = keyed.withColumn("_hash", F.xxhash64("_vector"))
    component = F.coalesce("component_id", "_id")
    same = (F.col("_hash") == F.col("hash")) & (F.col("_vector") == F.col("vector"))
    return keyed.join(found, same, "left").select(
        F.col("_id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(False)).alias("kept"),
    )


def passes_for(classes: int, threshold: float, window: int, miss: float) -> int:
    """Orders after which a pair at the threshold is lost with a chance of ``miss`` at most.

    Both ends are on the same side of a plane with the chance p = 1 - angle / pi. They are
    neighbours in an order if they share so many of its first bits that ``window`` classes at
    most do, which are log2(classes / window) bits, rounded up.
    """
    shared = max(0, math.ceil(math.log2(max(classes, 1) / window)))
    found = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** shared
    return 1 if found >= 1 else math.ceil(math.log(miss) / math.log1p(-found))


def _window_links(groups, width, threshold, passes, bits, window, seed) -> DataFrame:
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = np.random.default_rng(seed).normal(size=(max(width, 1), passes * bits))
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if len(batch):
                points = vectors.unit(vectors.stack(batch["vector"], width))
                for turn in range(passes):
                    sides = points @ planes[:, turn * bits : (turn + 1) * bits] > 0
                    number = batch["number"]
                    yield pd.DataFrame({"pass": turn, "key": sides @ weights, "number": number})

    hashed = groups.select("number", "vector").mapInPandas(
        keys, "pass int, key bigint, number bigint"
    )
    placed = ordering.along(hashed, ["pass", "key", "number"], "place")
    block = F.floor(F.col("place") / BLOCK)
    # the first rows of a block also stand behind the block before it
    seen = F.when(
        (F.col("place") % BLOCK < window) & (block > 0), F.array(block, block - 1)
    ).otherwise(F.array(block))
    dealt = (
        placed.join(groups.select("number", "vector"), "number")
        .withColumn("block", F.explode(seen))
        .select("block", "place", "pass", "number", "vector")
    )

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place", ignore_index=True)
        lengths = part["vector"].map(len).to_numpy()
        unit = vectors.unit(vectors.stack(part["vector"], width))
        turn, number = part["pass"].to_numpy(), part["number"].to_numpy()
        own = int((part["place"].to_numpy() // BLOCK == part["block"].iloc[0]).sum())
        connected = np.arange(len(part))
        for start in range(0, own, ROWS):
            rows = np.arange(start, min(start + ROWS, own))
            them = np.arange(start, min(rows[-1] + window + 1, len(part)))
            apart = them[None, :] - rows[:, None]
            close = (apart > 0) & (apart <= window) & (turn[rows][:, None] == turn[them])
            close &= lengths[rows][:, None] == lengths[them]
            close &= unit[rows] @ unit[them].T >= threshold
            a, b = np.nonzero(close)
            connected = joined(connected, rows[a], them[b])
        ends = np.flatnonzero(connected != np.arange(len(part)))
        return pd.DataFrame({"a": number[ends], "b": number[connected[ends]]})

    found = dealt.groupBy("block").applyInPandas(compare, "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def joined(connected: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``connected`` with more links: for every row the first one that it is connected with.

    The larger of two labels is hung on the smaller, then all pointers are followed to the end,
    until the two ends of every link have one label.
    """
    while True:
        one, two = connected[a], connected[b]
        apart = one != two
        if not apart.any():
            return connected
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        connected = connected.copy()
        np.minimum.at(connected, np.maximum(one, two), np.minimum(one, two))
        while True:
            farther = connected[connected]
            if np.array_equal(farther, connected):
                break
            connected = farther


def _links_within(linked: DataFrame, width: int, threshold: float) -> DataFrame:
    """``(number, links)``: for every class, the rows of other classes of its component it links."""
    bins = max(1, linked.count() // CHUNK)  # small components share a task
    sizes = linked.groupBy("root").agg(F.count("*").alias("_members"))
    split = F.ceil(F.col("_members") / CHUNK)
    # a large component is dealt in chunks that meet two by two
    placed = (
        linked.join(sizes, "root")
        .withColumn("_split", split)
        .withColumn("chunk", F.pmod(F.xxhash64("number"), "_split"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_split") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .withColumn("bin", F.when(F.col("_split") > 1, F.col("root")).otherwise(
            F.pmod(F.xxhash64("root"), F.lit(bins))
        ))
        .withColumn("large", F.col("_split") > 1)
    )

    def count(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["root", "number"], ignore_index=True)
        unit = vectors.unit(vectors.stack(part["vector"], width))
        lengths = part["vector"].map(len).to_numpy()
        weight = part["size"].to_numpy()
        chunk, root = part["chunk"].to_numpy(), part["root"].to_numpy()
        low, high = part["low"].iloc[0], part["high"].iloc[0]
        links = np.zeros(len(part), np.int64)
        edges = np.flatnonzero(np.r_[True, root[1:] != root[:-1], True])
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            rows = np.arange(start, end)
            a, b = rows[chunk[rows] == low], rows[chunk[rows] == high]
            close = (unit[a] @ unit[b].T >= threshold) & (lengths[a][:, None] == lengths[b])
            if low == high:
                np.fill_diagonal(close, False)
                links[a] += close @ weight[a]
            else:
                links[a] += close @ weight[b]
                links[b] += close.T @ weight[a]
        return pd.DataFrame({"number": part["number"], "links": links})

    counted = placed.groupBy("large", "bin", "low", "high").applyInPandas(
        count, "number bigint, links bigint"
    )
    return materialized(
        counted.groupBy("number").agg(F.sum("links").alias("links")), "vector-links"
    )
