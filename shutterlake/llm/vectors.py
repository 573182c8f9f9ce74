"""Rows of vectors: which take part, and classes of equal vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.llm.ordering import dense


def usable(vector: str):
    """True for a vector that is not null, not empty, not all zero and wholly finite."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def members(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``(id, vector)`` of the rows that take part: usable vector and an id."""
    return df.select(F.col(id_column).alias("id"), F.col(vector).alias("vector")).where(
        F.col("id").isNotNull() & usable("vector")
    )


def classes(rows: DataFrame, name: str, *more: Column) -> DataFrame:
    """One row ``(number, rep, size, ..., vector)`` for all rows of an equal vector.

    Numbers are unique, from 0; ``rep`` is the smallest id, which classes may share if an id
    repeats with another vector. Partial aggregation combines a large group of copies before
    the shuffle.
    """
    grouped = rows.groupBy("vector").agg(
        F.min("id").alias("rep"), F.count("*").alias("size"), *more
    )
    return dense(grouped, "number", name)


def dimension(rows: DataFrame) -> int:
    """The largest vector length, 0 for an empty table."""
    return rows.agg(F.max(F.size("vector"))).first()[0] or 0


def stack(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are padded with zeros."""
    lengths = vectors.map(len).to_numpy()
    if (lengths == width).all():
        return np.stack(vectors.to_numpy()).astype(np.float64)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def unit(points: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by their largest component first, so that no square overflows."""
    points = points / np.abs(points).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def smallest_ids(rows: DataFrame, group: str, keep: int) -> DataFrame:
    """The ``keep`` smallest distinct ids of a group; tasks pass on no more than that."""
    window = Window.partitionBy(group).orderBy("id")
    return (
        rows.withColumn("_place", F.row_number().over(window))
        .where(F.col("_place") <= keep)
        .drop("_place")
    )
