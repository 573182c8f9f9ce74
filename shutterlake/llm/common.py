"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


PIECE_BYTES = 4 << 20


def ensure_shared(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session without the setting (a test) gets a temporary folder, which is the
    driver's own and lies on the one machine there is; a cluster without it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    importable(spark)
    return folder


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, as in local runs."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (paths, root)))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{ensure_shared(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


WRITTEN: list[str] = []  # intermediate tables that this driver has written and not removed


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, until ``discard``."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, keep: int = 0) -> None:
    """Removes intermediate tables but the first ``keep``, once what was made of them is written.

    Results that are not written yet can not be computed afterwards.
    """
    for path in WRITTEN[keep:]:
        remove(spark, path)
    del WRITTEN[keep:]


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_shared(df.sparkSession)
    return df.checkpoint()


def least_hashed(rows: DataFrame, group: str, key: str, keep: int) -> DataFrame:
    """The ``keep`` rows with the smallest hash ``key`` of every group.

    Hashes are even, so rows far above the share that is kept need not be sorted: about half as
    many again as are kept meet in a group's task, whatever the table's size. The counts are a
    row for each group, written so that Spark knows their size.
    """
    counts = materialized(rows.groupBy(group).agg(F.count("*").alias("_n")), "group-sizes")
    share = F.col(key).cast("double") / 2.0**64 + 0.5
    near = rows.join(counts, group).where(share < (1.5 * keep + 50) / F.col("_n")).drop("_n")
    order = Window.partitionBy(group).orderBy(key, *[c for c in rows.columns if c != key])
    placed = near.withColumn("_place", F.row_number().over(order))
    return placed.where(F.col("_place") <= keep).drop("_place")


def annotate(
    df: DataFrame, column: str, added: str, function: Callable[[pa.Array], list]
) -> DataFrame:
    """``df`` with the columns ``added`` (DDL), computed by ``function`` from one column.

    ``function`` gets the values of a batch and returns one sequence for each added column.
    Added columns replace columns whose names Spark takes for the same, whatever their case.
    """
    new = StructType.fromDDL(added)
    replaced = {c.lower() for c in new.fieldNames()}
    kept = [c for c in df.columns if c.lower() not in replaced]
    own = [c for c in kept if c.lower() == column.lower()]
    value = own[0] if own else "_annotated_value"
    source = df.select(*[F.col(f"`{c}`") for c in kept])
    if not own:
        source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(value))
    schema = StructType([f for f in source.schema.fields if f.name in kept] + new.fields)
    arrow = arrow_types(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            results = function(batch.column(batch.schema.get_field_index(value)))
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            for result, (_, kind) in zip(results, arrow, strict=True):
                arrays.append(result if isinstance(result, pa.Array) else pa.array(result, kind))
            yield pa.RecordBatch.from_arrays(arrays, names=kept + [n for n, _ in arrow])

    return source.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches a few megabytes at a time, so that long texts do not fill a worker."""
    for batch in batches:
        if batch.num_rows:
            rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)


def arrow_types(schema: StructType) -> list[tuple[str, pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [(f.name, to_arrow_type(f.dataType)) for f in schema.fields]


def crc_remainder(column: str, modulus: int):
    """``crc32`` of the id as text, modulo ``modulus``; NULL ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus))
