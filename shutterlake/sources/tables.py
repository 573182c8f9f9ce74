"""Parquet tables: read, publish, append and merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake.operators.upsert import upsert
from shutterlake.session import checkpointed

BUCKET = "bucket"
LOADED = ("loaded_at", "loaded_on")  # what a change has beside the table's columns
REMOVED = "_removed"  # true in the newest version of a key that was taken out


def read_table(
    spark: SparkSession, root: str, name: str, merge_schema: bool = False
) -> DataFrame:
    """A table; ``merge_schema`` also finds columns that only its newer files have."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return reader.parquet(f"{root.rstrip('/')}/{name}")


def read_table_or_none(
    spark: SparkSession, root: str, name: str, merge_schema: bool = False
) -> DataFrame | None:
    try:
        return read_table(spark, root, name, merge_schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_by: str,
    low: int | str,
    high: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read by ``partitions`` tasks, split on a numeric or date column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=split_by)
        .options(lowerBound=low, upperBound=high, numPartitions=partitions, **options)
        .load()
    )


def publish(df: DataFrame, name: str, kind: str, root: str | None = None) -> DataFrame:
    """A model as a temporary view, or rebuilt as a parquet table below ``root``."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table" or root is None:
        raise ValueError("kind must be view, or table with a root")
    spark, target = df.sparkSession, f"{root.rstrip('/')}/{name}"
    # written beside the table, which stays whole if this breaks off, then exchanged
    df.write.mode("overwrite").parquet(_stage(root, name))
    files, path = _files(spark, target)
    files.delete(path, True)
    files.mkdirs(path.getParent())
    files.rename(_files(spark, _stage(root, name))[1], path)
    return read_table(spark, root, name)


def append(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("append").parquet(f"{root.rstrip('/')}/{name}")


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """A hash bucket of the key, as a partition column for tables without a natural one."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def merge(
    batch: DataFrame,
    root: str,
    name: str,
    keys: Sequence[str],
    partition: str,
    keep: Sequence[str] = (),
    touch: dict[str, Column] | None = None,
) -> DataFrame:
    """Upserts ``batch`` into a table partitioned by ``partition``, a function of the keys.

    Only the partitions the batch touches are read and rewritten. Keys that the batch lacks stay
    in the table, and columns that are new in the batch are added. The new partitions are
    staged below ``root`` first, because a path cannot be read and overwritten in one job. A
    stage that is complete is the only whole copy while partitions are exchanged; the next
    merge, or ``recover``, finishes an exchange that broke off. One job at a time may write a
    table. The batch is read several times: pass a checkpointed frame unless it is cheap.
    """
    spark = batch.sparkSession
    target = f"{root.rstrip('/')}/{name}"
    recover(spark, root, name, partition)
    current = read_table_or_none(spark, root, name, merge_schema=True)
    if current is None:
        # append, because an earlier merge of an empty batch left the folder without data
        first = _by_partition(batch, partition).write.mode("append")
        first.partitionBy(partition).parquet(target)
        return spark.read.schema(batch.schema).parquet(target)
    old = current.join(batch.select(partition).distinct(), partition, "left_semi")
    columns = [*keys, *([] if partition in keys else [partition])]
    new = upsert(old.select(*current.columns), batch, columns, keep, touch)
    new.write.mode("overwrite").parquet(_stage(root, name))
    recover(spark, root, name, partition)
    return spark.read.schema(new.schema).parquet(target)


def recover(spark: SparkSession, root: str, name: str, partition: str) -> bool:
    """Puts a completely staged merge in place; an incomplete one is dropped. Repeatable."""
    stage = _stage(root, name)
    files, path = _files(spark, stage)
    if not files.exists(path):
        return False
    complete = files.exists(_files(spark, f"{stage}/_SUCCESS")[1])
    if complete:
        (
            _by_partition(spark.read.parquet(stage), partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(f"{root.rstrip('/')}/{name}")
        )
    files.delete(path, True)
    return complete


def _stage(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_staged/{name}"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


# -- tables that are loaded by appending changes --------------------------------------------


def add_changes(batch: DataFrame, root: str, name: str, loaded_at: Column) -> None:
    """Appends new versions of rows; nothing of the table is read or rewritten.

    A repeated load appends the same versions again, which changes nothing for readers.
    """
    stamp = loaded_at.cast("timestamp")
    changes = batch.withColumns(dict(zip(LOADED, (stamp, F.to_date(stamp)), strict=True)))
    changes.write.mode("append").partitionBy(LOADED[1]).parquet(_changes(root, name))


def add_removals(keys: DataFrame, root: str, name: str, loaded_at: Column) -> None:
    """Takes keys out of a table: a change without a row, which readers and folds respect.

    A later load of the key brings it back. ``keys`` has the table's key columns.
    """
    add_changes(keys.withColumn(REMOVED, F.lit(True)), root, name, loaded_at)


def _marked(newest: DataFrame | None, base: DataFrame | None) -> DataFrame | None:
    """Changes that say of every key that it is there, if the table may say otherwise."""
    if newest is None or base is None or REMOVED in newest.columns or REMOVED not in base.columns:
        return newest
    return newest.withColumn(REMOVED, F.lit(False))


def _present(df: DataFrame) -> DataFrame:
    """Rows that have not been taken out."""
    if REMOVED not in df.columns:
        return df
    return df.where(~F.coalesce(REMOVED, F.lit(False))).drop(REMOVED)


def _changes(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}_changes"


def has_changes(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a table has loads that are not folded yet."""
    return read_table_or_none(spark, root, f"{name}_changes") is not None


def newest_changes(
    spark: SparkSession,
    root: str,
    name: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame | None:
    """The newest version of each changed key, by load time, then ``order``; columns in ``keep``
    come from its first version. Versions are combined before the shuffle."""
    changes = read_table_or_none(spark, root, f"{name}_changes", merge_schema=True)
    if changes is None:
        return None
    columns = [c for c in changes.columns if c not in LOADED]
    if REMOVED in columns and set(columns) == {*keys, REMOVED}:
        return changes.select(*keys, REMOVED).distinct()
    rest = [c for c in columns if c not in keys]
    text = F.xxhash64(F.to_json(F.struct(*rest)))
    newest = F.max_by(F.struct(*rest), F.struct(LOADED[0], *order, text)).alias("_new")
    first = [F.min_by(c, LOADED[0]).alias(f"_first_{c}") for c in keep]
    found = changes.groupBy(*keys).agg(newest, *first)
    return found.select(
        *[
            F.col(c) if c in keys else F.col(f"_first_{c}" if c in keep else f"_new.{c}").alias(c)
            for c in columns
        ]
    )


def read_keyed(
    spark: SparkSession,
    root: str,
    name: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame | None:
    """A table with its changes applied, None if there is neither.

    Folded rows without a change pass an anti join, which needs no shuffle of them while the
    changed keys are few enough for Spark to broadcast; ``fold`` keeps them few.
    """
    base = read_table_or_none(spark, root, name, merge_schema=True)
    newest = _marked(newest_changes(spark, root, name, keys, order, keep), base)
    if base is None:
        return newest and _present(newest)
    base = base.drop(BUCKET)
    return _present(base if newest is None else upsert(base, newest, keys, keep))


def read_key(
    spark: SparkSession,
    root: str,
    name: str,
    keys: Sequence[str],
    value,
    order: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame | None:
    """The row of one value of the first key, read from its bucket and the changes alone."""
    base = read_table_or_none(spark, root, name, merge_schema=True)
    newest = _marked(newest_changes(spark, root, name, keys, order, keep), base)
    buckets = layout(spark, root, name)
    if base is not None and buckets is not None:
        bucket = F.pmod(F.xxhash64(F.lit(value)), F.lit(buckets)).cast("int")
        number = spark.range(1).select(bucket).first()[0]
        base = base.where(F.col(BUCKET) == number)
    wanted = F.col(keys[0]) == F.lit(value)
    base = base and base.drop(BUCKET).where(wanted)
    newest = newest and newest.where(wanted)
    if base is None:
        return newest and _present(newest)
    return _present(base if newest is None else upsert(base, newest, keys, keep))


def fold(
    spark: SparkSession,
    root: str,
    name: str,
    keys: Sequence[str],
    buckets: int,
    order: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> None:
    """Moves the changes of a table into its buckets, by hash of the first key.

    ``buckets`` is a layout choice made once: it is stored beside the table, and another number
    is refused, as it would give a row two places. A fold that broke off can be repeated.
    Changes that arrive while it runs stay. What was taken out stays in its bucket as a mark.
    """
    stored = layout(spark, root, name)
    if stored not in (None, buckets):
        raise ValueError(f"{name} has {stored} buckets, not {buckets}")
    newest = newest_changes(spark, root, name, keys, order, keep)
    if newest is None:
        return
    read = newest.inputFiles()
    newest = _marked(newest, read_table_or_none(spark, root, name, merge_schema=True))
    if stored is None:
        spark.range(1).coalesce(1).select(F.lit(buckets).alias("buckets")).write.mode(
            "overwrite"
        ).json(f"{root.rstrip('/')}/_layout/{name}")
    batch = checkpointed(with_bucket(newest, keys[0], buckets))
    merge(batch, root, name, keys, BUCKET, keep)
    for file in read:  # one for each load and task since the last fold
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def layout(spark: SparkSession, root: str, name: str) -> int | None:
    """The number of buckets a table was folded into, None before that."""
    path = f"{root.rstrip('/')}/_layout/{name}"
    if not _files(spark, path)[0].exists(_files(spark, path)[1]):
        return None
    row = spark.read.schema("buckets int").json(path).first()
    return row and row["buckets"]


def _by_partition(df: DataFrame, partition: str) -> DataFrame:
    """Rows of a partition brought together for few files; Spark splits the large ones."""
    return df.hint("rebalance", partition)
