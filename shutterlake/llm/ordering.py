"""Numbers from 0 for the rows of a table, also along an order, without one task that sees all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shutterlake.llm.common import materialized

AT = "_at"  # place in the written table: the part in the upper bits, the row in it below
ROW_BITS = 33


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder, with each row's part and place in it as ``_at``."""
    return materialized(df.withColumn(AT, F.monotonically_increasing_id()), name)


def part_starts(table: DataFrame) -> dict[int, int]:
    """For each part of a written table the number of rows before it; one entry for each part."""
    part = F.shiftright(AT, ROW_BITS)
    counts = table.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts, before = {}, 0
    for row in sorted(counts.collect(), key=lambda r: r["part"]):
        starts[row["part"]] = before
        before += row["n"]
    return starts


def dense(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` written and read again, with a unique number from 0 for every row."""
    table = written(df, name)
    spark = df.sparkSession
    starts = spark.createDataFrame(list(part_starts(table).items()), "_part bigint, _start bigint")
    part = F.shiftright(AT, ROW_BITS).alias("_part")
    in_part = F.col(AT).bitwiseAND((1 << ROW_BITS) - 1)
    # one row for each part of the table
    joined = table.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn(column, in_part + F.col("_start")).drop("_part", "_start", AT)


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in sorted ranges, each a part; ``order`` should be a total order."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def along(df: DataFrame, order: list[str], column: str) -> DataFrame:
    """``df`` with each row's place, from 0, in an order."""
    return dense(in_order(df, order), column, f"ordered-{column}")


def among_alike(table: DataFrame, keys: list[str], column: str) -> DataFrame:
    """A written table with each row's number, from 1, among the rows alike in ``keys``.

    Rows are numbered inside their part of the table and shifted by the rows alike in the parts
    before, so a key that a third of all rows have is numbered by as many tasks as it has parts.
    """
    part = F.shiftright(AT, ROW_BITS)
    rows = table.withColumn("_part", part)
    inside = Window.partitionBy(*keys, "_part").orderBy(AT)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    shifts = shifts.withColumn("_shift", F.sum("_n").over(before)).where("_shift > 0")
    named = {c: f"_{c}_alike" for c in (*keys, "_part")}
    shifts = shifts.drop("_n").withColumnsRenamed(named)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()]
    condition = same[0]
    for each in same[1:]:
        condition = condition & each
    return (
        rows.withColumn("_inside", F.row_number().over(inside))
        .join(shifts, condition, "left")
        .withColumn(column, F.col("_inside") + F.coalesce("_shift", F.lit(0)))
        .drop("_inside", "_shift", "_part", AT, *named.values())
    )
