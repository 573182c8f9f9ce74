"""Duplicate cleanup, row filter and schema changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.operators.upsert import latest

# Operation name and text of the cleanup log.
OPERATION = "duplicate_user_cleanup"
DETAILS = "Cleaned up duplicate users for email %s. Kept ID: %s, Removed IDs: %s"


def dedup_latest(users: DataFrame, key: str = "email") -> DataFrame:
    """The newest row of each key by updated_at. Rows without a key all stay."""
    keyed = users.where(F.col(key).isNotNull())
    newest = latest(keyed, [key], [F.desc("updated_at"), F.asc("id")])
    return newest.unionByName(users.where(F.col(key).isNull()))


def dedup_counts(users: DataFrame, key: str = "email") -> DataFrame:
    """Per key of which ``dedup_latest`` removes rows: the id kept and the number removed."""
    kept = F.min_by("id", _newest_first())
    return (
        users.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(kept.alias("kept_id"), (F.count("*") - 1).alias("affected_records"))
        .where("affected_records > 0")
        .select(F.lit(OPERATION).alias("operation"), key, "kept_id", "affected_records")
    )


def dedup_removed(users: DataFrame, key: str = "email") -> DataFrame:
    """What ``dedup_latest`` removes, one row for each removed row: (operation, key, kept_id,
    removed_id). The newest comes first in each key; of rows alike in time and id all but one
    are removed."""
    order = Window.partitionBy(key).orderBy(_newest_first())
    rows = users.where(F.col(key).isNotNull()).select(
        key, F.col("id").alias("removed_id"), F.row_number().over(order).alias("_rn")
    )
    kept = dedup_counts(users, key).select(F.col(key).alias("_key"), "kept_id", "operation")
    return (
        rows.where("_rn > 1")
        .join(kept, F.col(key) == F.col("_key"))
        .select("operation", key, "kept_id", "removed_id")
    )


def referring(removed: DataFrame, children: DataFrame, reference: str) -> DataFrame:
    """Rows that refer to a removed id, each with the id that is kept in its place."""
    ids = removed.select(F.col("removed_id").alias("_id"), "kept_id")
    return children.join(ids, F.col(reference) == F.col("_id")).drop("_id")


def dedup_log(users: DataFrame, key: str = "email") -> DataFrame:
    """The cleanup log as text: one row for each key with removed rows, which names their ids.

    One key's ids form one row; ``dedup_removed`` has them one by one.
    """
    entries = F.sort_array(F.collect_list(F.struct(_newest_first().alias("_order"), "id")))
    ids = F.transform(entries, lambda entry: entry["id"].cast("string"))
    return (
        users.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(ids.alias("_ids"))
        .where(F.size("_ids") > 1)
        .select(
            F.lit(OPERATION).alias("operation"),
            F.format_string(
                DETAILS,
                F.col(key).cast("string"),
                F.get("_ids", 0),
                F.array_join(F.slice("_ids", 2, F.size("_ids")), ", "),
            ).alias("details"),
            (F.size("_ids") - 1).cast("bigint").alias("affected_records"),
        )
    )


def _newest_first() -> Column:
    return F.struct(-F.unix_micros(F.col("updated_at").cast("timestamp")), "id")


def cleanup_summary(logs: DataFrame) -> DataFrame:
    """Per operation: runs, affected records, first and last run."""
    return logs.groupBy("operation").agg(
        F.count("*").alias("total_runs"),
        F.sum("affected_records").alias("total_records_affected"),
        F.min("created_at").alias("first_run"),
        F.max("created_at").alias("last_run"),
    )


def row_filter(df: DataFrame, owner: str, caller: str) -> DataFrame:
    """The rows a caller owns. A convenience, not a security boundary."""
    return df.where(F.col(owner) == caller)


def evolve(df: DataFrame, columns: dict[str, str], backfill: dict[str, Column] | None = None):
    """``df`` with missing columns added as NULL, then NULLs of ``backfill`` filled."""
    added = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    df = df.withColumns(added) if added else df
    filled = {c: F.coalesce(F.col(c), value) for c, value in (backfill or {}).items()}
    return df.withColumns(filled) if filled else df


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]
