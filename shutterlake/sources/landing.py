"""Readers of JSON-lines files that a collector drops into a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake import schemas
from shutterlake.functions import columns as X
from shutterlake.operators.normalize import CORRUPT, judge

FEEDS = {
    "photos": schemas.RAW_PHOTO,
    "collection_photos": schemas.RAW_PHOTO,
    "user_photos": schemas.RAW_PHOTO,
    "photo_statistics": schemas.RAW_STATISTICS,
    "collections": schemas.RAW_COLLECTION,
    "user_statistics": schemas.RAW_USER_STATISTICS,
}


def read_feed(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """One feed with its fixed schema. Lines that do not fit keep their text in ``_corrupt``."""
    if kind not in FEEDS:
        raise ValueError(f"kind must be one of {', '.join(FEEDS)}: {kind}")
    return _read_json(spark, path, FEEDS[kind])


def read_photos(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_feed(spark, path, "photos")


def empty_feed(spark: SparkSession, kind: str) -> DataFrame:
    """A feed of which nothing is to be read."""
    return spark.createDataFrame([], f"{FEEDS[kind]}, {CORRUPT} string")


def photo_batch(
    raw: DataFrame, batch_size: int | None = None, order_by: str = "latest"
) -> DataFrame:
    """The first ``batch_size`` loadable records of a feed, latest or most liked first, and all
    records that cannot be loaded, so that none of them is lost track of.

    Without a batch size the whole feed is the batch. Creation times are compared as instants.
    """
    if order_by not in ("latest", "popular"):
        raise ValueError(f"order_by must be latest or popular: {order_by}")
    if batch_size is None:
        return raw
    judged = raw if "reason" in raw.columns else judge(raw)
    order = X.parse_ts("created_at") if order_by == "latest" else F.col("likes")
    good = judged.where("reason is null").orderBy(F.desc(order), "id").limit(batch_size)
    return good.unionByName(judged.where("reason is not null"))


def read_search(spark: SparkSession, path: str) -> DataFrame:
    """Search responses ``{results, total, total_pages}``: one row per result.

    A page that is no such response is one row that keeps its text in ``_corrupt``.
    """
    schema = f"results array<struct<{_fields(schemas.RAW_PHOTO)}>>, total bigint, total_pages bigint"
    pages = _read_json(spark, path, schema)
    rows = pages.select("total", "total_pages", CORRUPT, F.explode_outer("results").alias("photo"))
    rows = rows.where(F.col(CORRUPT).isNotNull() | F.col("photo").isNotNull())
    return rows.select("total", "total_pages", "photo.*", CORRUPT)


def read_search_log(spark: SparkSession, path: str) -> DataFrame:
    """A search log, one row a line, with a ``reason`` for lines that are no search."""
    log = _read_json(spark, path, "search_term string, searched_at timestamp")
    return judge_log(log)


def judge_log(log: DataFrame) -> DataFrame:
    """``log`` with a ``reason``: malformed, or the fields that are missing; else NULL."""
    if CORRUPT not in log.columns:
        log = log.withColumn(CORRUPT, F.lit(None).cast("string"))
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("search_term", "searched_at")]
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise(
        F.nullif(F.concat_ws(",", *missing), F.lit(""))
    )
    return log.withColumn("reason", reason)


def _read_json(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _fields(schema: str) -> str:
    from pyspark.sql.types import StructType

    inner = StructType.fromDDL(schema).simpleString()
    return inner[len("struct<") : -1]
