"""Raw photo records to photo rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shutterlake.functions import columns as X
from shutterlake.schemas import REQUIRED

CORRUPT = "_corrupt"


def judge(raw: DataFrame) -> DataFrame:
    """``raw`` with a ``reason`` for every record that cannot be loaded, NULL for the others.

    A record is bad if it is not valid JSON of the schema, or if a required field is missing
    or a timestamp does not parse.
    """
    missing = [
        F.when((X.parse_ts(c) if c.endswith("_at") else F.col(c)).isNull(), F.lit(c))
        for c in REQUIRED["photos"]
    ]
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise(
        F.nullif(F.concat_ws(",", *missing), F.lit(""))
    )
    return raw.withColumn("reason", reason)


def split_bad(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Loadable records, and the rest with a reason. Judged records are taken as they are."""
    judged = raw if "reason" in raw.columns else judge(raw)
    good = judged.where("reason is null").drop("reason", CORRUPT)
    return good, judged.where("reason is not null")


def normalize_photos(raw: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """Flat photo rows: user fields lifted, timestamps parsed, tags cleaned.

    Missing maps and lists become empty. Missing counters stay NULL until staging, which
    reads them as 0.
    """
    no_map = F.create_map().cast("map<string,string>")
    no_list = F.array().cast("array<string>")
    return raw.select(
        "id",
        X.parse_ts("created_at").alias("created_at"),
        X.parse_ts("updated_at").alias("updated_at"),
        "width",
        "height",
        "color",
        "blur_hash",
        "downloads",
        "likes",
        "views",
        "description",
        "alt_description",
        F.coalesce("urls", no_map).alias("urls"),
        F.coalesce("links", no_map).alias("links"),
        F.col("user.id").alias("user_id"),
        F.col("user.name").alias("user_name"),
        F.col("user.username").alias("user_username"),
        F.coalesce("location", no_map).alias("location"),
        F.coalesce("exif", no_map).alias("exif"),
        X.clean_tags("tags").alias("tags"),
        F.coalesce("categories", no_list).alias("categories"),
        (F.lit(None) if extracted_at is None else extracted_at)
        .cast("timestamp")
        .alias("extracted_at"),
    )


def enrich(basic: DataFrame, details: DataFrame, stats: DataFrame) -> DataFrame:
    """Each basic record replaced as a whole by its details record where one exists, with its
    statistics (NULL where there are none) attached."""
    names = [c for c in basic.columns if c not in ("id", "statistics")]
    detail = details.select("id", F.struct(*names).alias("_details"))
    totals = F.struct(*[c for c in stats.columns if c != "id"]).alias("statistics")
    record = F.coalesce("_details", "_basic")
    return (
        basic.select("id", F.struct(*names).alias("_basic"))
        .join(detail, "id", "left")
        .join(stats.select("id", totals), "id", "left")
        .select("id", record.alias("_record"), "statistics")
        .select("id", "_record.*", "statistics")
    )
