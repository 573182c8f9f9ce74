"""Table checks. Each returns the offending keys or counts; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. NULL keys do not count."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold NULLs, with the number of rows, from one pass over the table."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return nulls.unpivot([], list(columns), "column_name", "rows").where("rows > 0")


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of ``fk`` without a row in ``parent``, with their number of child rows.

    The child is reduced to its distinct values before the join, so a frequent value costs
    one row.
    """
    used = (
        child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("rows"))
    )
    return used.join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """The child rows behind ``check_foreign_key``."""
    return child.where(F.col(fk).isNotNull()).join(
        parent.select(F.col(key).alias(fk)), fk, "left_anti"
    )
