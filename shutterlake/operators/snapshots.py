"""Statistics snapshots and their deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.functions import columns as X

KEY = ["photo_id", "recorded_at"]
# total -> delta column. The names of the statistics table.
DELTAS = {"downloads": "download_delta", "likes": "likes_delta", "views": "views_delta"}


def photo_statistics(raw: DataFrame, recorded_at) -> DataFrame:
    """Snapshot rows of the photos whose raw record carries statistics; missing totals are 0."""
    totals = [X.or_zero(f"statistics.{t}.total").alias(t) for t in DELTAS]
    present = F.col("statistics").isNotNull() & F.greatest(
        *[F.col(f"statistics.{t}").isNotNull() for t in DELTAS]
    )
    return raw.where(present).select(
        F.col("id").alias("photo_id"), recorded_at.alias("recorded_at"), *totals
    )


def stat_deltas(snapshots: DataFrame, unit: str = "day", tie: str | None = None) -> DataFrame:
    """Each snapshot's totals and their change since the photo's previous snapshot.

    The first snapshot's change is its total. The previous row is found in two steps, inside
    (photo, ``unit``) and between the units of a photo, so that a photo with very many
    snapshots is split over its units. Only unit ends cross between them.
    """
    return _changes(_with_previous(snapshots, unit, tie), snapshots.columns)


def _with_previous(
    snapshots: DataFrame, unit: str, tie: str | None, also: tuple[str, ...] = ()
) -> DataFrame:
    """``snapshots`` with totals and ``also`` as a struct ``_now``, and the one before it."""
    order = ["recorded_at"] + ([tie] if tie else [])
    now = F.struct(*[X.or_zero(t).alias(t) for t in DELTAS], *also)
    rows = snapshots.withColumns({"_unit": F.date_trunc(unit, "recorded_at"), "_now": now})
    inside = Window.partitionBy("photo_id", "_unit").orderBy(*order)
    rows = rows.withColumn("_before", F.lag("_now").over(inside))
    ends = rows.groupBy("photo_id", "_unit").agg(
        F.max_by("_now", F.struct(*order)).alias("_end")
    )
    between = Window.partitionBy("photo_id").orderBy("_unit")
    carried = ends.select("photo_id", "_unit", F.lag("_end").over(between).alias("_carried"))
    rows = rows.join(carried, ["photo_id", "_unit"])
    return rows.withColumn("_before", F.coalesce("_before", "_carried"))


def _changes(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(
        *[F.col(f"_now.{c}").alias(c) if c in DELTAS else c for c in names],
        *[
            (F.col(f"_now.{t}") - F.coalesce(F.col(f"_before.{t}"), F.lit(0))).alias(delta)
            for t, delta in DELTAS.items()
        ],
    )


def placed_deltas(known: DataFrame, new: DataFrame, unit: str = "day") -> DataFrame:
    """Deltas of new snapshots, and of the known ones that directly follow one of them.

    For every new snapshot ``known`` must hold the photo's nearest ones before and after it;
    it may hold others. A new snapshot replaces a known one of the same photo and time.
    """
    names = new.columns
    rest = known.select(*names).join(new.select(*KEY), KEY, "left_anti")
    both = rest.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    rows = _with_previous(both, unit, None, ("_new",))
    return _changes(rows.where(F.col("_new") | F.col("_before._new")), names)


def days_of(snapshots: DataFrame) -> DataFrame:
    """``(photo_id, month, days)``: the days with snapshots of a photo, one bit each."""
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth("recorded_at") - 1)
    month = F.trunc("recorded_at", "month")
    return snapshots.groupBy("photo_id", month.alias("month")).agg(F.bit_or(bit).alias("days"))


def merged_days(days: DataFrame) -> DataFrame:
    return days.groupBy("photo_id", "month").agg(F.bit_or("days").alias("days"))


def days_beside(days: DataFrame, late: DataFrame) -> DataFrame:
    """``(photo_id, recorded_on)``: the days that hold what comes before and after late snapshots.

    For each late snapshot those are its own day and the nearest days on both sides that have
    snapshots of its photo, as ``days`` (see ``days_of``) tells.
    """
    asked = late.select("photo_id").distinct()
    bits = merged_days(days.join(asked, "photo_id", "left_semi"))
    held = F.filter(
        F.sequence(F.lit(0), F.lit(30)),
        lambda i: F.col("days").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0,
    )
    have = bits.select("photo_id", "month", F.explode(held).alias("i")).select(
        "photo_id", F.date_add("month", F.col("i")).alias("day"), F.lit(True).alias("held"),
        F.lit(False).alias("asked"),
    )
    wanted = late.select(
        "photo_id", F.to_date("recorded_at").alias("day"), F.lit(False).alias("held"),
        F.lit(True).alias("asked"),
    ).distinct()
    each = have.unionByName(wanted).groupBy("photo_id", "day")
    each = each.agg(F.bool_or("held").alias("held"), F.bool_or("asked").alias("asked"))
    order = Window.partitionBy("photo_id").orderBy("day")
    day = F.when(F.col("held"), F.col("day"))
    before = F.last(day, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    back = Window.partitionBy("photo_id").orderBy(F.desc("day"))
    after = F.last(day, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    beside = each.select("photo_id", "asked", F.array(before, day, after).alias("beside"))
    found = beside.where("asked").select("photo_id", F.explode("beside").alias("recorded_on"))
    return found.where("recorded_on is not null").distinct()


def latest_snapshots(history: DataFrame, tie: str | None = None) -> DataFrame:
    """The newest snapshot of each photo, with a map-side combine."""
    order = F.struct("recorded_at", *([tie] if tie else []))
    rest = [c for c in history.columns if c != "photo_id"]
    return (
        history.groupBy("photo_id")
        .agg(F.max_by(F.struct(*rest), order).alias("s"))
        .select("photo_id", "s.*")
    )


def new_stat_deltas(
    batch: DataFrame, history: DataFrame, unit: str = "day", tie: str | None = None
) -> DataFrame:
    """Deltas of a new batch against the stored history, of which only the last rows count."""
    names = batch.columns
    photos = batch.select("photo_id").distinct()
    last = latest_snapshots(history.join(photos, "photo_id", "left_semi").select(*names), tie)
    both = last.select(*names, F.lit(False).alias("_new")).unionByName(
        batch.withColumn("_new", F.lit(True))
    )
    return stat_deltas(both, unit, tie).where("_new").drop("_new")
