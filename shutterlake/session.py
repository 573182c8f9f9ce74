"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Spark's own setting: shuffle files go with the action that made them
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "shutterlake", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without one there is no place for data that several tasks read, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/shutterlake/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """``df`` written once to the shared folder, so that several readers do not recompute it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def staged(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function like ``checkpointed`` for frames that nothing reads after the block.

    They are written as compressed Parquet and removed at the block's end. Shuffle files go after
    each action inside the block; else both stay until the driver collects its garbage.
    """
    paths: list[str] = []

    def stage(df: DataFrame) -> DataFrame:
        paths.append(scratch(spark, "staged"))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield stage
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
