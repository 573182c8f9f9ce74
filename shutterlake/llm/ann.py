"""Approximate nearest neighbours along shifted Hilbert curves.

Every curve orders all vectors by a Hilbert index of a few random projections. A query takes the
rows next to it in every order; the windows of all curves are merged, so that each candidate is
compared once, and the candidates are ranked by their exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.llm import vectors
from shutterlake.llm.common import materialized

CELL = 1 << 12  # neighbouring rows of the curves that one task looks at
RANGE = 1 << 16  # rows of a range of a curve, about
TIE = 7  # bits of the hash that parts rows of one cell
BLOCK = 1 << 13  # vectors that one task compares with queries
QUERIES = 1 << 12  # queries that meet a block in one task


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of grid cells (one row each) on the Hilbert curve of that many bits an axis."""
    small = np.int16 if bits < 15 else np.int64
    axes = [cells[:, i].astype(small) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i, axis in enumerate(axes):
            turned = (axis >> level) & 1 == 1
            swap = np.where(turned, 0, (axes[0] ^ axis) & low)
            flipped = np.where(turned, axes[0] ^ low, axes[0])
            axes[0] = flipped ^ swap
            if i:
                axes[i] = axis ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((axes[-1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    axes = [axis ^ flip for axis in axes]
    index = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        digit = np.zeros(len(cells), np.int64)  # one bit of every axis
        for axis in axes:
            digit = digit << 1 | (axis >> level) & 1
        index = index << len(axes) | digit
    return index


CURVES = 64


def window_for(rows: int) -> int:
    """Rows to either side on each of ``CURVES``, so that unstructured vectors are found.

    Measured on vectors of 64 independent dimensions, whose nearest ten are hardly nearer than
    all others: recall is 0.95 or more with 64 rows of 10,000 and 256 of 50,000.
    """
    return max(16, int(np.ceil(64 * (rows / 10_256) ** 0.862)))


def nearest(
    df: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    window: int | None = None,
    curves: int = CURVES,
    axes: int = 8,
    bits: int = 7,
    fitted: int = 4096,
    seed: int = 5,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the nearest ``k`` found for every row with ``is_query``.

    Each of ``curves`` orders projects all vectors on ``axes`` random directions, cuts every direction at the quantiles of the corpus, shifts the
    resulting grid by a random number of cells and sorts along its Hilbert curve of ``2**bits``
    cells an axis, in ranges that Spark sorts; rows of one cell are ordered by a hash of their
    own in every curve. The quantiles, and where ranges begin, are those of ``fitted`` vectors
    with the smallest hashes.
    A query meets the ``window`` rows (``window_for`` the table by default) before and behind its
    place in every order. The windows
    are merged, and candidates are ranked by Euclidean distance in double precision on the
    original vectors, ties by smaller id. If the windows together would hold as many rows as
    the table, all rows are compared instead, in blocks, and the answer is exact.

    A query's work is ``2 * window * curves`` rows at most, fewer where windows overlap. On data
    with structure far smaller windows find as much as ``window_for`` allows for.

    Equal vectors are one class; of a class the ``k + 1`` smallest ids can be answers, which is
    all that ranking needs. Rows whose vector is null, empty, zero or has null or non-finite
    components, and rows without an id, take no part. Shorter vectors count as padded with
    zeros. Rows of one id and one vector count once; rows of one id with different vectors are
    queries and candidates of their own. Other columns are not read.
    """
    rows = df.select(
        F.col(id_column).alias("id"),
        F.col(vector).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).where(F.col("id").isNotNull() & vectors.usable("vector"))
    groups = vectors.classes(rows, "curve-classes", F.max("asked").alias("asked"))
    width, total = vectors.dimension(groups), groups.count()
    found = _ranked(groups, _requests(groups, width, total, window, curves, axes, bits, fitted, seed), width, total, k)
    # by the vector's hash first, which is cheaper to sort than vectors
    own = groups.select("number", "rep", F.xxhash64("vector").alias("_hash"), "vector")
    named = rows.withColumn("_hash", F.xxhash64("vector")).join(own, ["_hash", "vector"])
    named = named.groupBy("id", "number", "rep").agg(F.max("asked").alias("asked"))
    answers = vectors.smallest_ids(named.select("id", F.col("number").alias("found")), "found", k + 1)
    by_query = Window.partitionBy("query_id", "number").orderBy("score", "id")
    own = (F.col("id") == F.col("query_id")) & (F.col("found") == F.col("number"))
    return (
        named.where("asked").select(F.col("id").alias("query_id"), "number")
        .join(found, "number")
        .join(answers, "found")
        .where(~own)
        .withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_column), "score")
    )


def _requests(groups, width, total, window, curves, axes, bits, fitted, seed) -> DataFrame:
    """``(block, number, ids)``: which vectors of a block each query is compared with, as packed
    numbers; NULL for all of them."""
    window = window or window_for(total)
    asked = groups.where("asked").select("number")
    if 2 * window * curves >= total:
        blocks = F.sequence(*[F.lit(n).cast("bigint") for n in (0, max(0, total - 1) // BLOCK)])
        every = asked.select(F.explode(blocks).alias("block"), "number")
        return every.withColumn("ids", F.lit(None).cast("binary"))
    places = _places(groups, width, curves, axes, bits, fitted, seed)
    return _merged(_windows(places, total, window))


def _places(groups, width, curves, axes, bits, fitted, seed) -> DataFrame:
    """``(part, row, own)``: along all curves, each class as twice its number, and one more if it
    is a query, with its place in its range of its curve."""
    total = groups.count()
    rng = np.random.default_rng(seed)
    shape = (max(width, 1), axes)
    if width < axes:
        directions = [rng.normal(size=shape) for _ in range(curves)]
    else:
        directions = [np.linalg.qr(rng.normal(size=shape))[0] for _ in range(curves)]
    directions = np.concatenate(directions, axis=1)
    half = 1 << (bits - 1)
    shifts = rng.integers(0, half + 1, curves * axes)
    sample = groups.orderBy(F.xxhash64("vector"), "number").limit(fitted).select("vector")
    points = vectors.stack(sample.toPandas()["vector"], width)  # of bounded number
    cuts = np.quantile(points @ directions, np.arange(1, half) / half, axis=0)

    def index(points: np.ndarray, c: int) -> np.ndarray:
        own = slice(c * axes, (c + 1) * axes)
        at = (points @ directions[:, own]).T
        cells = [
            np.searchsorted(edge, axis) + shift
            for edge, axis, shift in zip(cuts[:, own].T, at, shifts[own], strict=True)
        ]
        return hilbert_index(np.minimum(np.stack(cells, axis=1), (1 << bits) - 1), bits)

    # each curve is cut into ranges of about as many rows, by the indices of the sample; a
    # hash of the row stands behind the index, so that rows of one cell are cut as well
    ranges = -(-total // RANGE)
    edges = [
        np.sort(index(points, c) << TIE | hashed(np.arange(len(points)), c))[
            np.arange(1, ranges) * len(points) // ranges
        ]
        for c in range(curves if ranges > 1 else 0)
    ]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, asked = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            points = vectors.stack(batch.column(2).to_pandas(), width)
            if not len(number):
                continue
            own = 2 * number + asked
            for c in range(curves):
                key = index(points, c)
                part = np.full(len(key), c * ranges)
                if ranges > 1:
                    part += np.searchsorted(edges[c], key << TIE | hashed(number, c))
                columns = [pa.array(x, pa.int64()) for x in (part, key, own)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "key", "own"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = -1, 0
        for batch in batches:
            part, own = batch.column(0).to_numpy(), batch.column(1)
            firsts = np.flatnonzero(np.diff(part, prepend=current))
            row = np.arange(len(part)) + held
            for first in firsts.tolist():  # ranges that begin here
                row[first:] = np.arange(len(part) - first)
            if len(part):
                current, held = int(part[-1]), int(row[-1]) + 1
            columns = [batch.column(0), pa.array(row, pa.int64()), own]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "row", "own"])

    keyed = groups.select("number", "asked", "vector").mapInArrow(
        keys, "part bigint, key bigint, own bigint"
    )
    tie = F.xxhash64("own", "part")
    ordered = keyed.repartition("part").sortWithinPartitions("part", "key", tie, "own")
    rows = ordered.select("part", "own").mapInArrow(count, "part bigint, row bigint, own bigint")
    return materialized(rows, "curve-places")


def hashed(number: np.ndarray, curve: int) -> np.ndarray:
    """``TIE`` bits of a hash of each number, another one for every curve."""
    h = (number + 1) * 0x9E3779B1 ^ (curve + 1) * 0x85EBCA6B
    return (h ^ h >> 15) * 0xC2B2AE35 >> 13 & (1 << TIE) - 1


def _windows(places: DataFrame, total: int, window: int) -> DataFrame:
    """``(number, ids)``: for every query and curve the rows of its window, as packed numbers."""
    sizes = places.groupBy("part").agg((F.max("row") + 1).alias("n")).collect()
    n = np.zeros(max((r["part"] for r in sizes), default=0) + 2, np.int64)  # one for each range
    for r in sizes:
        n[r["part"] + 1] = r["n"]
    start = np.cumsum(n)
    size = max(CELL, 2 * window)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, row, own = (batch.column(i).to_numpy() for i in (0, 1, 2))
            place = start[part] + row
            cell = place // size
            out = []
            for step, edge in ((0, None), (-1, place % size < window), (1, place % size >= size - window)):
                use = np.arange(len(place)) if edge is None else np.flatnonzero(edge)
                target = cell[use] + step
                order = np.argsort(target, kind="stable")
                use, target = use[order], target[order]
                cuts = np.flatnonzero(np.diff(target)) + 1
                for rows, to in zip(np.split(use, cuts), np.split(target, cuts), strict=True):
                    if len(rows):
                        out.append((int(to[0]), place[rows].tobytes(), own[rows].tobytes()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("cell", "place", "own"), o, strict=True)) for o in out],
                schema=pa.schema([("cell", pa.int64()), ("place", pa.binary()), ("own", pa.binary())]),
            )

    def look(rows: pa.Table) -> pa.Table:
        cell = rows.column("cell")[0].as_py()
        place, own = (
            np.frombuffer(b"".join(rows.column(c).to_pylist()), np.int64) for c in ("place", "own")
        )
        order = np.argsort(place)
        place, own = place[order], own[order]
        number = own >> 1
        queries = np.flatnonzero((own & 1 == 1) & (place // size == cell))
        curve = place[queries] // total * total
        low = np.searchsorted(place, np.maximum(place[queries] - window, curve))
        high = np.searchsorted(place, np.minimum(place[queries] + window, curve + total - 1), "right")
        ids = [number[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        return pa.table({"number": pa.array(number[queries], pa.int64()), "ids": pa.array(ids, pa.binary())})

    dealt = places.mapInArrow(deal, "cell bigint, place binary, own binary")
    return dealt.groupBy("cell").applyInArrow(look, "number bigint, ids binary")


def _merged(windows: DataFrame) -> DataFrame:
    """The windows of a query merged, each candidate once, and dealt by blocks of vectors."""

    def merge(rows: pa.Table) -> pa.Table:
        number = rows.column("number")[0].as_py()
        ids = np.unique(np.frombuffer(b"".join(rows.column("ids").to_pylist()), np.int64))
        block = ids // BLOCK
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        parts = np.split(ids, cuts[1:])
        return pa.table({
            "block": pa.array(block[cuts], pa.int64()),
            "number": pa.array(np.full(len(cuts), number), pa.int64()),
            "ids": pa.array([p.tobytes() for p in parts], pa.binary()),
        })

    merged = windows.groupBy("number").applyInArrow(merge, "block bigint, number bigint, ids binary")
    return materialized(merged, "curve-candidates")


def distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; where squares overflow or vanish, of scaled differences."""
    apart = points - query
    with np.errstate(over="ignore"):
        found = np.sqrt((apart**2).sum(axis=1))
    odd = np.flatnonzero(~np.isfinite(found) | (found < 1e-140))
    if len(odd):
        scale = np.abs(apart[odd]).max(axis=1, initial=0.0)
        safe = np.where(scale > 0, scale, 1.0)
        found[odd] = scale * np.sqrt(((apart[odd] / safe[:, None]) ** 2).sum(axis=1))
    return found


def _ranked(groups: DataFrame, requests: DataFrame, width: int, total: int, k: int) -> DataFrame:
    """``(number, found, score)``: the nearest ``k + 1`` classes of every query."""
    queries = groups.where("asked").select("number", F.col("vector").alias("query"))
    slices = max(1, -(-queries.count() // QUERIES))
    own = F.pmod(F.xxhash64("number"), F.lit(slices)).cast("int").alias("slice")
    asked = requests.join(queries, "number").select("block", own, "number", "ids", "query")
    stored = groups.select(
        F.floor(F.col("number") / BLOCK).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.col("number").alias("member"), F.col("rep").alias("rep"), F.col("vector").alias("vector"),
    )

    def compare(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"number": [], "found": [], "rep": [], "score": []})]
        if len(block) and len(asked):
            block = block.sort_values("member", ignore_index=True)
            points, rep = vectors.stack(block["vector"], width), block["rep"].to_numpy()
            number = block["member"].to_numpy()
            query = vectors.stack(asked["query"], width)
            for i, (name, ids) in enumerate(zip(asked["number"], asked["ids"], strict=True)):
                near = np.arange(len(points)) if ids is None else np.frombuffer(ids, np.int64) - number[0]
                distance = distances(points[near], query[i])
                if len(near) > k + 1:  # ties at the edge stay in
                    edge = np.partition(distance, k)[k]
                    near, distance = near[distance <= edge], distance[distance <= edge]
                best = np.lexsort((rep[near], distance))[: k + 1]
                out.append(pd.DataFrame({
                    "number": name, "found": number[near[best]], "rep": rep[near[best]],
                    "score": distance[best],
                }))
        return pd.concat(out)

    found = (
        stored.groupBy("block", "slice")
        .cogroup(asked.groupBy("block", "slice"))
        .applyInPandas(compare, "number bigint, found bigint, rep bigint, score double")
    )
    by_class = Window.partitionBy("number").orderBy("score", "rep", "found")
    found = found.withColumn("_n", F.row_number().over(by_class)).where(F.col("_n") <= k + 1)
    return found.select("number", "found", "score")
