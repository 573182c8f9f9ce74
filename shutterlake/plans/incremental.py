"""Keeps the tag and pair cells up with the loads of the photos table.

A ledger names the change files that a version of the cells has taken in. A refresh reads the
files that are not in it, the old and the new version of the photos they change, and the cells
these touch, and appends the cells' new values with the next version; the ledger's rows commit
it. Cells of a refresh that broke off have no committed version and are not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake.operators import cells
from shutterlake.session import checkpointed
from shutterlake.sources import tables

LEDGER = "cell_ledger"
TAGS, PAIRS = "tag_cells", "pair_cells"
NARROW = ["created_at", "likes", "downloads", "views", "tags"]
FOLDED = "folded"  # stands in the ledger for photos that were folded before the first refresh


def _versions(photos: DataFrame | None, changes: DataFrame | None) -> DataFrame:
    """All stored versions of photos with the load and file they came with."""
    parts = []
    if photos is not None:
        before = F.lit(None).cast("struct<a:timestamp,b:timestamp,c:bigint>").alias("_order")
        parts.append(photos.select("id", *NARROW, before, F.lit(FOLDED).alias("file")))
    if changes is not None:
        rest = [c for c in changes.columns if c != "id" and c not in tables.LOADED]
        text = F.xxhash64(F.to_json(F.struct(*rest)))
        order = F.struct(
            F.col(tables.LOADED[0]).alias("a"), F.col("updated_at").alias("b"), text.alias("c")
        )
        file = F.col("_metadata.file_path").alias("file")
        parts.append(changes.select("id", *NARROW, order.alias("_order"), file))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest(versions: DataFrame) -> DataFrame:
    first = F.coalesce(F.col("_order.a").isNotNull(), F.lit(False))
    newest = F.max_by(F.struct(*NARROW), F.struct(first, "_order"))
    return versions.groupBy("id").agg(newest.alias("p")).select("id", "p.*")


def refresh(spark: SparkSession, root: str) -> int | None:
    """Takes the loads since the last refresh into the cells; their new version, None if there
    was nothing to take in."""
    photos = tables.read_table_or_none(spark, root, "photos", merge_schema=True)
    changes = tables.read_table_or_none(spark, root, "photos_changes", merge_schema=True)
    if photos is None and changes is None:
        return None
    ledger = tables.read_table_or_none(spark, root, LEDGER)
    stored = _versions(photos, changes)
    if ledger is None:
        version, known, fresh = 0, None, stored
    else:
        version = ledger.agg(F.max("version")).first()[0] + 1
        seen = ledger.select("file").union(spark.range(1).select(F.lit(FOLDED))).distinct()
        known = stored.join(seen, "file", "left_semi")
        fresh = stored.join(seen, "file", "left_anti")
    files = checkpointed(fresh.select("file").distinct())
    if files.isEmpty():
        return None
    if known is None:  # all photos changed
        old, new = None, checkpointed(_newest(stored))
    else:
        changed = checkpointed(fresh.select("id").distinct())
        new = checkpointed(_newest(stored.join(changed, "id", "left_semi")))
        old = checkpointed(_newest(known.join(changed, "id", "left_semi")))
    _move_tags(spark, root, old, new, stored, version)
    _move(spark, root, PAIRS, cells.pair_deltas(old, new), cells.PAIR_KEYS, cells.PAIR_SUMS, version)
    tables.append(files.withColumn("version", F.lit(version)).coalesce(1), root, LEDGER)
    return version


def _move(spark, root, name, deltas, keys, sums, version) -> None:
    touched = cells.moved(*_touched(spark, root, name, deltas, version), keys, sums)
    _append(touched, root, name, version)


def _move_tags(spark, root, old, new, stored, version) -> None:
    deltas = cells.tag_deltas(old, new)
    found = _touched(spark, root, TAGS, deltas, version)
    touched = checkpointed(cells.moved(*found, cells.TAG_KEYS, cells.TAG_SUMS))
    # one row for each day of the calendar at most
    days = [r[0] for r in touched.where("stale").select("day").distinct().collect()]
    own = stored.where(F.to_date("created_at").isin([d for d in days if d is not None]))
    ids = own.select("id").distinct()
    photos = _newest(stored.join(ids, "id", "left_semi")) if days else new.limit(0)
    _append(cells.rederived(touched, photos), root, TAGS, version)


def _touched(spark, root, name, deltas, version) -> tuple[DataFrame, DataFrame | None]:
    """The deltas, and the stored cells of their months."""
    deltas = checkpointed(deltas)
    if version == 0:
        return deltas, None
    month = F.trunc("day", "month")
    months = [r[0] for r in deltas.select(month).distinct().collect()]
    near = F.col("month").isin([m for m in months if m is not None])
    return deltas, read(spark, root, name, near | F.col("month").isNull(), whole=True)


def _append(touched: DataFrame, root: str, name: str, version: int) -> None:
    rows = touched.withColumns({"version": F.lit(version), "month": F.trunc("day", "month")})
    rows = rows.hint("rebalance", "month")  # few files for a month
    rows.write.mode("append").partitionBy("month").parquet(f"{root.rstrip('/')}/{name}")


def read(spark: SparkSession, root: str, name: str, where=None, whole: bool = False) -> DataFrame:
    """The committed cells of a table; ``whole`` also gives those that lost all their photos."""
    keys = cells.TAG_KEYS if name == TAGS else cells.PAIR_KEYS
    stored = tables.read_table(spark, root, name)
    if where is not None:
        stored = stored.where(where)
    committed = tables.read_table(spark, root, LEDGER).agg(F.max("version")).first()[0]
    rest = [c for c in stored.columns if c not in (*keys, "version", "month")]
    newest = F.max_by(F.struct(*rest), "version").alias("cell")
    found = stored.where(F.col("version") <= committed).groupBy(*keys).agg(newest)
    found = found.select(*keys, "cell.*")
    return found if whole else found.where("photos > 0")
