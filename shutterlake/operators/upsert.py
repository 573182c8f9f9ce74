"""Keyed upserts and latest-row deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must end in a unique column.

    Spark limits each key to one row per task before the shuffle, so a key with very many
    copies does not gather them anywhere.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = (),
    touch: dict[str, Column] | None = None,
) -> DataFrame:
    """``current`` with the rows of ``batch`` inserted or put in place of their key's row.

    Every column is replaced, NULLs included, except those in ``keep``, which an existing row
    retains. ``touch`` gives values that only replaced rows get. Keys must be unique in
    ``batch``. A column of ``current`` that ``batch`` lacks counts as kept; one that only
    ``batch`` has is NULL in the rows that stay. Rows of
    ``current`` without a partner pass through an anti join, which needs no shuffle of
    ``current`` while the batch is small enough for Spark to broadcast its keys.
    """
    keys = list(keys)
    new_columns = [f for f in batch.schema.fields if f.name not in current.columns]
    current = current.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new_columns})
    kept = [c for c in current.columns if c in keep or c not in batch.columns]
    touched = touch or {}
    batch_keys = batch.select(*keys)
    untouched = current.join(batch_keys, keys, "left_anti")
    if kept or touched:
        old = current.join(batch_keys, keys, "left_semi").select(
            *keys, F.struct(F.lit(True).alias("hit"), *kept).alias("_old")
        )
        batch = batch.join(old, keys, "left")
    hit = F.col("_old.hit").isNotNull()

    def value(name):
        new = F.col(name) if name in batch.columns else F.lit(None)
        if name in touched:
            new = F.when(hit, touched[name]).otherwise(new)
        elif name in kept:
            new = F.when(hit, F.col(f"_old.{name}")).otherwise(new)
        return new.cast(current.schema[name].dataType).alias(name)

    return untouched.select(*current.columns).unionByName(
        batch.select(*[F.col(c) if c in keys else value(c) for c in current.columns])
    )
