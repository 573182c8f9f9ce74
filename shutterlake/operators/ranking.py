"""Global row numbers and pages that do not pull the whole table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.session import checkpointed

INDEX_BITS = 33  # width of the row index inside monotonically_increasing_id


def rank_by_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with ``name``, each row's number in ``order``, from 1.

    Rows are split into sorted ranges of the full order, numbered inside their range, and
    shifted by the number of rows in the ranges before. The ranged frame is checkpointed
    because range bounds are sampled and both readers must see the same split. The offsets
    are one row per partition. ``order`` must be a total order.
    """
    ranged = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    ranged = ranged.select(
        "*",
        F.shiftright("_slot", INDEX_BITS).alias("_range"),
        F.col("_slot").bitwiseAND((1 << INDEX_BITS) - 1).alias("_index"),
    ).drop("_slot")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + F.col("_index") + 1)
        .drop("_range", "_index", "_offset")
    )


def top_page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the given order, as a top-k: every task keeps
    ``offset + limit`` rows. For pages near the beginning."""
    return df.orderBy(*order).offset(offset).limit(limit)


def deep_page(df: DataFrame, order: Sequence[Column], limit: int, offset: int) -> DataFrame:
    """The same page where ``offset`` may be anywhere: rows are numbered by ranges, and those
    before the page never meet in one task. ``order`` must be a total order."""
    ranked = rank_by_ranges(df, order, "_rank")
    wanted = (F.col("_rank") > offset) & (F.col("_rank") <= offset + limit)
    return ranked.where(wanted).orderBy("_rank").drop("_rank")


BINS = 1024  # counts that one round of a selection returns
NEAR = 10_000  # rows that are sorted to end a selection


def selected_page(
    df: DataFrame, value: str, key: str, limit: int, offset: int = 0
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by ``value`` descending (NULL last), then ``key``.

    The table is not sorted. Rounds of counting narrow the band of values that holds the page,
    each to about a thousandth; each round is one scan with a filter and returns ``BINS``
    counts. Only the rows of the last band are sorted. If more than ``NEAR`` rows share a
    value, the band of their keys is narrowed in the same way, letter by letter. ``value`` is an
    integer or a time, ``key`` a unique string.
    """
    number = _number(df, value)
    rows = df.withColumn("_value", number)
    low, high, present, total = rows.agg(
        F.min("_value"), F.max("_value"), F.count("_value"), F.count("*")
    ).first()
    last = min(offset + limit, total)
    if offset >= total or limit < 1:
        return df.limit(0)
    page = _band(rows, low, high, present, key, offset, min(last, present) - offset)
    if last > present:  # the page reaches into rows without a value
        skip = max(0, offset - present)
        page += _keys(rows.where("_value is null"), key, skip, last - present - skip)
    found = page[0]
    for part in page[1:]:
        found = found.unionByName(part)
    return found.orderBy(F.desc_nulls_last("_value"), F.asc(key)).drop("_value")


def _number(df: DataFrame, value: str) -> Column:
    kind = df.schema[value].dataType.typeName()
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(value).cast("timestamp"))
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    return F.col(value).cast("bigint")


def _band(rows, low, high, held, key, offset, length) -> list[DataFrame]:
    """The ``length`` rows from ``offset`` on of the rows with values, as parts."""
    if length < 1:
        return []
    above = 0  # rows with larger values than the band's
    while held > NEAR + length and low < high:
        width = -(-(high - low + 1) // BINS)
        band = rows.where(F.col("_value").between(low, high))
        step = F.floor((F.lit(high).cast("decimal(20,0)") - F.col("_value")) / F.lit(width))
        counts = dict(band.groupBy(step.cast("int").alias("b")).agg(F.count("*")).collect())
        first, last, before, within = None, None, above, 0
        for b in sorted(counts):
            if before + counts[b] > offset and first is None:
                first, above = b, before
            if first is not None and last is None:
                within += counts[b]
                last = b if before + counts[b] >= offset + length else None
            before += counts[b]
        low, high, held = max(low, high - (last + 1) * width + 1), high - first * width, within
        if len(counts) == 1 and width == 1:
            break
        if (last - first + 1) * width >= BINS * width and held > NEAR + length:
            break
    if low == high and held > NEAR + length:
        return _keys(rows.where(F.col("_value") == low), key, offset - above, length)
    if low < high and held > NEAR + length:
        # the page lies on both sides of a value that very many rows share
        return _split(rows, low, high, key, offset - above, length)
    band = rows.where(F.col("_value").between(low, high))
    return [band.orderBy(F.desc("_value"), F.asc(key)).offset(offset - above).limit(length)]


def _split(rows, low, high, key, skip, length) -> list[DataFrame]:
    """The page taken value by value; so many values hold it as it has rows, at most."""
    parts = []
    band = rows.where(F.col("_value").between(low, high))
    while length > 0:
        top = band.agg(F.max("_value").alias("v")).first()["v"]
        own = band.where(F.col("_value") == top)
        count = own.count()
        if skip < count:
            taken = min(length, count - skip)
            parts += _keys(own, key, skip, taken)
            length, skip = length - taken, 0
        else:
            skip -= count
        band = band.where(F.col("_value") < top)
    return parts


def _keys(rows: DataFrame, key: str, offset: int, length: int) -> list[DataFrame]:
    """The ``length`` rows from ``offset`` on by ``key``."""
    if length < 1:
        return []
    first, last = (_key_at(rows, key, place) for place in (offset, offset + length - 1))
    return [rows.where(F.col(key).between(first, last))]


def _key_at(rows: DataFrame, key: str, place: int) -> str:
    """The key at a place, counted from 0: its letters are found one after another."""
    prefix = ""
    while True:
        own = rows.where(F.startswith(F.col(key), F.lit(prefix)))
        letter = F.substring(F.col(key), F.lit(len(prefix) + 1), F.lit(1))
        counts = own.groupBy(letter.alias("c")).agg(F.count("*").alias("n")).collect()
        if sum(r["n"] for r in counts) <= NEAR:
            return own.orderBy(key).offset(place).limit(1).select(key).first()[0]
        for c, n in sorted(counts, key=lambda r: r["c"].encode()):
            if place < n:
                break
            place -= n
        if not c:  # the key ends here
            return prefix
        prefix += c
