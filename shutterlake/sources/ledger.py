"""Which landed files a job has taken in, so that the next run parses only what is new.

A file is known by path, length and time of its last change: one that was written again counts
as new. Files are listed, not read, to find out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake.session import checkpointed
from shutterlake.sources import tables

LEDGER = "landed_files"
KEY = ["path", "length", "modificationTime"]


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a landing folder, without their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(*KEY)


def unseen(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """The files of a landing folder that are not in the ledger, listed once."""
    files = landed(spark, folder)
    known = tables.read_table_or_none(spark, root, LEDGER)
    return checkpointed(files if known is None else files.join(known, KEY, "left_anti"))


def record(files: DataFrame, root: str) -> None:
    """Writes files to the ledger, once what they hold is loaded."""
    rows = files.withColumn("recorded_at", F.current_timestamp())
    tables.append(rows.coalesce(1), root, LEDGER)


def paths(files: DataFrame) -> list[str]:
    """Their paths, which a reader needs to plan its scan."""
    return [r["path"] for r in files.select("path").collect()]
