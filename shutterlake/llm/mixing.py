"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target divided by its size is a document's expected number of copies. The whole part
is certain. The fraction is an inclusion probability, the same for all documents of a source,
and is rounded by the cube method: the vector of probabilities walks inside the unit cube along
the null space of two constraints, the number of tokens and the number of documents, until
(nearly) every coordinate is 0 or 1. The walk takes place in blocks of a source. Of each block a
few documents of all sizes stay behind; with what the walk leaves fractional, two at most, they
meet those of the source's other blocks in the next round, until the source is one block and
lands, whatever the size of other sources.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.llm import ordering
from shutterlake.llm.common import checkpointed, materialized

WEIGHTS = (3, 1, 2)  # repeating over the sources in order of code points, null last
SHARE = 1.5  # words the mix takes, as a share of all words
LIMIT = 2.0  # largest share of a source, and of a document
BLOCK = 2000  # fractional documents of a source that one task rounds together
LANDING = 10  # documents of a block that do not fly, for the landing of their source
EPSILON = 1e-9


def words_in(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    found = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(found, F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` of ``sizes(source, source_size)``, one row a source.

    Sources share ``SHARE`` of all words by weight. A target stops at ``LIMIT`` times the
    source's size, and the excess is shared by the others by weight until none is above: in
    the order of size per weight, a prefix of the sources stops, and the rest share what
    the prefix leaves. Source names of UTF-8 sort by code point. The table has a row for each
    source, not for each document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (turn + 1).cast("int"))
    ranked = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * LIMIT)
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (
        F.sum("source_size").over(everything) * SHARE
        - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(rest)
    # the level of the first source that stays below its cap holds for all behind it
    placed = ranked.withColumn("_level", level).withColumn("_turn", F.row_number().over(order))
    below = F.col("_level") * F.col("_weight") < F.col("_cap")
    final = F.min(F.when(below, F.struct("_turn", "_level")))
    shared = placed.withColumn("_final", final.over(everything))
    target = F.least("_cap", F.coalesce(F.col("_final._level") * F.col("_weight"), F.col("_cap")))
    return shared.select("source", "source_size", target.cast("double").alias("target"))


def row_key(id_column: str, text: str) -> Column:
    """Names a row by its id and text; it also decides the block and the draws."""
    return F.xxhash64(F.lit(3), F.col(id_column).cast("string"), F.col(text))


def mix(df: DataFrame, id_column: str, text: str, source: str) -> DataFrame:
    """``(id, source, size, source_size, target, copies, key, number)`` for every row of ``df``.

    ``size`` is the number of words and ``copies`` (0, 1 or 2) how often the mix takes the
    row. The flight keeps a source's expected words and documents; the landing rounds the
    last dozen documents to the sum nearest to the target. What remains is less than the
    largest document, and usually less than the smallest.

    Rows are told apart by ``key`` (of id and text) and rows alike by their ``number``, so
    reruns agree. Null sources are one source; null and empty texts have size 0 and get the
    whole part of the copies alone. A source without words has target 0 and no copies. Ids may
    be null. Other columns are not read.
    """
    rows = df.select(
        F.col(id_column).alias("id"),
        F.col(source).alias("source"),
        words_in(F.col(text)).alias("size"),
        row_key(id_column, text).alias("key"),
    )
    # rows alike in these are copies of one text: they are numbered, so that each can be told
    rows = ordering.among_alike(ordering.written(rows, "mix-rows"), ["source", "key", "size"], "number")
    rows = checkpointed(rows)
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )
    goals = targets(sizes.select("source", "source_size"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = (
        goals.withColumnRenamed("source", "goal_source")
        .join(
            sizes.select(F.col("source").alias("counted"), "documents"),
            F.col("goal_source").eqNullSafe(F.col("counted")),
        )
        .select(
            "goal_source", "source_size", "target", share.alias("share"),
            F.ceil(F.col("documents") / BLOCK).alias("blocks"),
        )
    )
    goals = materialized(goals, "mix-goals")  # so that Spark knows its size
    dealt = rows.join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        "id", "source", "size", "key", "number", "source_size", "target",
        F.floor("share").cast("int").alias("whole"),
        (F.col("share") - F.floor("share")).alias("chance"),
        F.pmod(F.xxhash64("key", "number"), "blocks").alias("block"), "blocks",
    )
    dealt = checkpointed(dealt)
    chances = dealt.where("chance > 0 and size > 0").select(
        "source", "block", "blocks", "size", "key", "chance", "number"
    )
    rounded = _rounds(chances, goals)
    return (
        dealt.join(
            rounded.select(
                F.col("key").alias("r_key"), F.col("size").alias("r_size"),
                F.col("source").alias("r_source"), F.col("number").alias("r_number"), "extra",
            ),
            (F.col("key") == F.col("r_key"))
            & (F.col("size") == F.col("r_size"))
            & F.col("source").eqNullSafe(F.col("r_source"))
            & (F.col("number") == F.col("r_number")),
            "left",
        )
        .select(
            "id", "source", "size", "source_size", "target",
            (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"), "key", "number",
        )
    )


def flight(sizes: np.ndarray, chances: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Moves chances to 0 or 1 while their sum and the expected size stay as they are.

    Three fractional units at a time span a space in which one direction keeps both
    constraints; a step along it, to either side with the odds that keep every expectation,
    ends at a face of the cube. At most two units stay fractional.
    """
    p = chances.tolist()
    x = sizes.tolist()
    active: list[int] = []
    draw = iter(draws.tolist())
    for unit in range(len(p)):
        if not EPSILON < p[unit] < 1 - EPSILON:
            continue
        active.append(unit)
        if len(active) < 3:
            continue
        i, j, k = active
        # orthogonal to the rows (1, 1, 1) and (x_i, x_j, x_k)
        u = (x[k] - x[j], x[i] - x[k], x[j] - x[i])
        if not any(u):
            u = (1, -1, 0)
        forth = back = math.inf
        for a, step in zip(active, u, strict=True):
            if step > 0:
                forth, back = min(forth, (1 - p[a]) / step), min(back, p[a] / step)
            elif step < 0:
                forth, back = min(forth, p[a] / -step), min(back, (1 - p[a]) / -step)
        move = forth if next(draw) * (forth + back) < back else -back
        for a, step in zip(active, u, strict=True):
            p[a] = min(1.0, max(0.0, p[a] + move * step))
        active = [a for a in active if EPSILON < p[a] < 1 - EPSILON]
        for a in (i, j, k):
            if a not in active:
                p[a] = float(round(p[a]))
    return np.array(p)


def land(sizes: np.ndarray, chances: np.ndarray, goal: float) -> np.ndarray:
    """Rounds the last few units of a source so that the sizes taken come nearest to ``goal``.

    All ways are tried: two units at most are left by the flight, and ``LANDING`` did not fly. If
    they can not make up for a unit much larger than they are, single units change sides, each
    time the one that brings the sum nearest.
    """
    p = np.where(chances >= 1 - EPSILON, 1.0, np.where(chances <= EPSILON, 0.0, chances))
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if len(open_):
        size, rest = sizes[open_], goal - float(sizes @ (p == 1))
        choice = np.array(np.meshgrid(*[[0, 1]] * len(open_))).reshape(len(open_), -1).T
        miss = np.abs(choice @ size - rest)
        near = np.abs(choice.sum(axis=1) - p[open_].sum())
        best = np.lexsort((np.arange(len(choice)), near, miss))[0]
        p[open_] = choice[best]
    miss = float(sizes @ p) - goal
    while True:
        after = np.abs(miss + sizes * (1 - 2 * p))
        one = int(after.argmin())
        if after[one] >= abs(miss) - EPSILON:
            return p
        miss += sizes[one] * (1 - 2 * p[one])
        p[one] = 1 - p[one]


def _rounds(chances: DataFrame, goals: DataFrame) -> DataFrame:
    """``(source, key, size, number, extra)``: 1 for every document that gets one copy more."""
    blocks = goals.agg(F.max("blocks")).first()[0] or 1
    current = chances
    schema = (
        "source string, block bigint, blocks bigint, size bigint, key bigint, chance double, "
        "number bigint"
    )
    # so many of a block are left at most: so many blocks fill one of the next round
    joined = max(2, BLOCK // (LANDING + 2))
    settled = None

    def fly(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size", "key", "number"], ignore_index=True)
        sizes, p = part["size"].to_numpy(np.float64), part["chance"].to_numpy(copy=True)
        keys = part["key"].to_numpy(np.int64).view(np.uint64) * part["number"].to_numpy(np.uint64)
        draws = np.random.default_rng(int(np.bitwise_xor.reduce(keys))).random(len(p))
        flying = np.ones(len(p), bool)
        # some of all sizes stay behind, so that the landing can meet the target
        flying[np.linspace(0, len(p) - 1, LANDING).astype(int)] = False
        goal = float(sizes @ p)
        p[flying] = flight(sizes[flying], p[flying], draws)
        last = part["blocks"].iloc[0] <= 1  # the source's own last block
        return part.assign(chance=land(sizes, p, goal) if last else p)

    while True:
        current = current.select("source", "block", "blocks", "size", "key", "chance", "number")
        done = checkpointed(current.groupBy("source", "block").applyInPandas(fly, schema))
        whole = done.where(f"chance >= 1 - {EPSILON}")
        settled = whole if settled is None else settled.unionByName(whole)
        if blocks <= 1:
            break
        blocks = math.ceil(blocks / joined)
        current = done.where(f"chance > {EPSILON} and chance < 1 - {EPSILON}").withColumns({
            "block": F.floor(F.col("block") / joined),
            "blocks": F.ceil(F.col("blocks") / joined),
        })
    return settled.select("source", "key", "size", "number", F.lit(1).alias("extra"))
