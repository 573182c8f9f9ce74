"""The photo model over the star-schema test tables, one function per table.

An order is a photo, its customer the photographer, its line items give tags and counters;
events give statistics snapshots, a search log and users; documents give long texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shutterlake.schemas import RAW_PHOTO

AS_OF = "2001-08-01"  # the newest order date at every scale factor
# the order of an order's lines; lines alike in these have the same tags
LINE_ORDER = ("l_linenumber", "l_partkey")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with two tags each: the part type and the second word of the part name."""
    parts = table(spark, folder, "part").select(
        "p_partkey",
        "p_brand",
        F.lower("p_type").alias("type_tag"),
        F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("name_tag"),
    )
    return table(spark, folder, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))


def photos(spark: SparkSession, folder: str) -> DataFrame:
    """Photos with their ordered tags, two for each line item; orders without any have NULL.

    A photo's tags are one value of its row, as in the photos table, so they are collected.
    """
    per_order = _lines(spark, folder).groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.count("*").alias("n"),
        F.min("p_brand").alias("color"),
        F.sort_array(F.collect_list(F.struct(*LINE_ORDER, "type_tag", "name_tag"))).alias("lines"),
    )
    pairs = F.transform("lines", lambda line: F.array(line["type_tag"], line["name_tag"]))
    key = F.col("o_orderkey")
    width = 1000 + key * 37 % 3000
    height = F.when(key % 11 == 0, width).otherwise(1000 + key * 53 % 3000)
    return (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(per_order, key == F.col("l_orderkey"), "left")
        .select(
            key.cast("string").alias("id"),
            F.col("o_orderdate").alias("created_at"),
            width.cast("int").alias("width"),
            height.cast("int").alias("height"),
            F.when(key % 13 != 0, F.col("quantity").cast("bigint")).alias("likes"),
            (F.coalesce("n", F.lit(0)) * 5).cast("bigint").alias("downloads"),
            F.when(key % 7 == 0, F.lit(0))
            .otherwise(F.floor(F.col("o_totalprice") / 10))
            .cast("bigint")
            .alias("views"),
            F.when(key % 101 != 0, F.col("o_custkey").cast("string")).alias("user_id"),
            F.col("c_name").alias("user_username"),
            F.col("c_mktsegment").alias("user_name"),
            "color",
            F.flatten(pairs).alias("tags"),
        )
    )


def statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics snapshots of photos; ``id`` breaks ties in time."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("photo_id"),
        F.col("ts").alias("recorded_at"),
        F.floor(F.col("value")).cast("bigint").alias("downloads"),
        F.col("event_id").alias("likes"),
        F.when(
            F.col("event_type") != "error",
            F.get_json_object("props", "$.k").cast("bigint"),
        ).alias("views"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """User rows with several rows per email."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("email"),
        F.col("ts").alias("updated_at"),
        F.col("event_type").alias("full_name"),
    )


def cleanup_logs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("operation"),
        F.get_json_object("props", "$.k").cast("bigint").alias("affected_records"),
        F.col("ts").alias("created_at"),
    )


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Run-log rows; an error has no end."""
    failed = F.col("event_type") == "error"
    return table(spark, folder, "events").select(
        F.concat_ws("-", "event_type", "event_id").alias("job_name"),
        F.when(failed, "failed").otherwise("completed").alias("status"),
        F.col("ts").alias("started_at"),
        F.when(~failed, F.col("ts")).alias("completed_at"),
        F.get_json_object("props", "$.k").cast("bigint").alias("records_processed"),
    )


def text_photos(spark: SparkSession, folder: str) -> DataFrame:
    """Photos with long descriptions."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("description"),
        F.lit(None).cast("string").alias("alt_description"),
        F.col("lang").alias("user_name"),
        F.col("source").alias("user_username"),
        F.col("n_chars").alias("likes"),
        (F.col("n_chars") % 97).alias("downloads"),
    )


def raw_photos(spark: SparkSession, folder: str) -> DataFrame:
    """Raw photo records as a collector would receive them, tags as a short list per record.

    Some lack an optional or required field, and timestamps come with several offsets.
    """
    key = F.col("o_orderkey")
    offset = F.when(key % 3 == 0, "Z").when(key % 3 == 1, "+02:00").otherwise("-05:30")
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), offset)

    def title(text):
        return F.struct(text.cast("string").alias("title"))

    priority = F.lower("o_orderpriority")
    tags = F.array(
        title(priority),
        title(F.lit("")),
        title(F.lower("c_mktsegment")),
        title(F.lit(None)),
        title(F.when(key % 2 == 0, priority).otherwise(F.lower("o_orderstatus"))),
    )
    return (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.cast("string").alias("id"),
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
            F.when(key % 19 != 0, 1000 + key * 37 % 3000).cast("int").alias("width"),
            (1000 + key * 53 % 3000).cast("int").alias("height"),
            F.concat(F.lit("#"), F.lpad(F.hex(key * 7919 % 256), 6, "0")).alias("color"),
            F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("downloads"),
            F.when(key % 13 != 0, key % 500).cast("bigint").alias("likes"),
            F.floor(F.col("o_totalprice") / 10).cast("bigint").alias("views"),
            F.col("o_orderpriority").alias("description"),
            F.struct(
                F.col("c_custkey").cast("string").alias("id"),
                F.col("c_mktsegment").alias("name"),
                F.col("c_name").alias("username"),
            ).alias("user"),
            F.when(key % 17 != 0, tags).alias("tags"),
            F.struct(
                F.struct(F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("total"))
                .alias("downloads"),
                F.struct((key % 500).cast("bigint").alias("total")).alias("likes"),
                F.lit(None).cast("struct<total:bigint>").alias("views"),
            ).alias("statistics"),
        )
        .to(StructType.fromDDL(RAW_PHOTO))
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The raw records as JSON lines; some are cut off after 30 characters."""
    raw = raw_photos(spark, folder)
    line = F.to_json(F.struct(*raw.columns))
    cut = F.col("id").cast("bigint") % 23 == 0
    return raw.select(F.when(cut, F.substring(line, 1, 30)).otherwise(line).alias("value"))
