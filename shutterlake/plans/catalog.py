"""One runnable query per operator over the test tables, each over its whole tables."""

from __future__ import annotations

import datetime as dt
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake import schemas
from shutterlake.functions import columns as X
from shutterlake.operators import cells, charts, cooccurrence, daily, maintenance, normalize
from shutterlake.operators import photographers, quality, reads, search, snapshots, staging
from shutterlake.operators import tags, upsert
from shutterlake.plans import elt, incremental
from shutterlake.session import SETTINGS, checkpointed, remove, scratch, staged
from shutterlake.sources import landing, search_index, star, tables
from shutterlake.streaming.ingest import stream_photos

AS_OF = star.AS_OF
PACKED_LINES = 100_000  # of a compressed landing file, which one task reads as a whole
LOG_AS_OF = "2024-01-30"  # the newest day of the events table
RECORDED = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _harness_folder(spark: SparkSession) -> None:
    """A scratch folder for local sessions that name none: tests, benches and the driver's."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def query(function: Query) -> Query:
    """Registers a query under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", SETTINGS["spark.sql.session.timeZone"])
        _harness_folder(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


def _stg(spark, folder):
    return staging.stg_photos(star.photos(spark, folder), AS_OF)


def _stg_bags(spark, folder):
    return tags.photo_bags(star.photos(spark, folder))


def _with_first_tag(spark, folder):
    return star.photos(spark, folder).withColumn("first_tag", X.first_tag()).drop("tags")


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def _csv(c: str):
    return F.array_join(c, ",")


# -- ingest and load ---------------------------------------------------------------------


def _landed_photos(spark, folder):
    path = scratch(spark, "landing-photos")
    star.raw_lines(spark, folder).write.text(path)
    return path


def _packed(spark, lines, path):
    """Landing files as a collector that compresses them drops them."""
    with staged(spark):
        packed = lines.write.option("compression", "gzip")
        packed.option("maxRecordsPerFile", PACKED_LINES).text(path)
    return path


@query
def ingest_photos(spark, folder):
    raw = landing.read_photos(spark, _landed_photos(spark, folder))
    good = F.col(normalize.CORRUPT).isNull()
    names = ("id", "created_at", "width", "height", "color", "likes", "views", "description")
    return landing.photo_batch(raw).select(
        *[F.when(good, F.col(c)).alias(c) for c in names],
        F.when(good, F.col("user.username")).alias("username"),
        F.when(good, F.size("tags")).alias("raw_tags"),
        F.col(normalize.CORRUPT).alias("corrupt"),
    )


@query
def ingest_search_results(spark, folder):
    raw = star.raw_photos(spark, folder)
    total = raw.agg(F.count("*").alias("n")).scalar()
    pages = (
        raw.groupBy(F.floor(F.col("id").cast("bigint") / 20).alias("page"))
        .agg(F.collect_list(F.struct(*raw.columns)).alias("results"))  # 20 records a page
        .select(
            "page",
            "results",
            total.alias("total"),
            F.ceil(total / 20).cast("bigint").alias("total_pages"),
        )
    )
    line = F.to_json(F.struct("results", "total", "total_pages"))
    line = F.when(F.col("page") % 7 == 3, F.substring(line, 1, 18)).otherwise(line)
    path = scratch(spark, "landing-search")
    pages.select(line.alias("value")).write.text(path)
    found = landing.read_search(spark, path)
    return found.select(
        "total", "total_pages", "id", "width", "color", F.col("user.id").alias("user_id"),
        F.col(normalize.CORRUPT).alias("corrupt"),
    )


@query
def ingest_collections(spark, folder):
    parts = star.table(spark, folder, "part")
    feed = parts.groupBy("p_brand").agg(
        F.count("*").alias("total_photos"), F.min("p_name").alias("description")
    )
    path = scratch(spark, "landing-collections")
    feed.select(F.col("p_brand").alias("id"), "description", "total_photos").write.json(path)
    read = landing.read_feed(spark, path, "collections")
    return read.select("id", "title", "description", "total_photos")


@query
def ingest_user_statistics(spark, folder):
    orders = star.table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.struct(F.count("*").alias("total")).alias("downloads"),
        F.struct(F.sum("o_orderkey").alias("total")).alias("views"),
    )
    path = scratch(spark, "landing-user-statistics")
    orders.withColumn("id", F.col("o_custkey").cast("string")).drop("o_custkey").write.json(path)
    read = landing.read_feed(spark, path, "user_statistics")
    return read.select(
        "id", F.col("downloads.total").alias("downloads"), F.col("views.total").alias("views")
    )


@query
def enrich_details(spark, folder):
    """Details exist for orders with line items, statistics for ids that occur in events."""
    basic = star.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("description"),
        F.lit(None).cast("bigint").alias("likes"),
    )
    details = (
        star.table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("id"))
        .agg(
            F.min("l_returnflag").alias("description"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("likes"),
        )
    )
    stats = (
        star.table(spark, folder, "events")
        .groupBy(F.col("user_id").cast("string").alias("id"))
        .agg(F.max("event_id").alias("likes"), F.count("*").alias("views"))
    )
    return normalize.enrich(basic, details, stats).select(
        "id",
        "description",
        "likes",
        F.col("statistics.likes").alias("stat_likes"),
        F.col("statistics.views").alias("stat_views"),
    )


def _normalized(spark, folder):
    good, _ = normalize.split_bad(star.raw_photos(spark, folder))
    return normalize.normalize_photos(good)


@query
def normalize_photos(spark, folder):
    rows = _ntz(_normalized(spark, folder), "created_at", "updated_at")
    sizes = [F.size(c).alias(f"{c}_size") for c in ("urls", "location", "exif", "categories")]
    return rows.select(
        "id", "created_at", "updated_at", "width", "height", "color", "blur_hash", "downloads",
        "likes", "views", "description", "user_id", "user_name", "user_username",
        _csv("tags").alias("tags"), *sizes,
    )


@query
def clean_tags(spark, folder):
    return star.raw_photos(spark, folder).select(
        "id", _csv(X.clean_tags("tags")).alias("tags"), F.size(X.clean_tags("tags")).alias("n")
    )


@query
def parse_iso_ts(spark, folder):
    return star.raw_photos(spark, folder).select(
        "id", "created_at", X.parse_ts("created_at").cast("timestamp_ntz").alias("parsed")
    )


@query
def skip_bad_records(spark, folder):
    raw = landing.read_photos(spark, _landed_photos(spark, folder))
    good, bad = normalize.split_bad(raw)
    kept = good.select("id", F.lit(None).cast("string").alias("reason"))
    malformed = F.col("reason") == "malformed"
    key = F.when(malformed, F.col(normalize.CORRUPT)).otherwise(F.col("id"))
    return kept.unionByName(bad.select(key.alias("id"), "reason"))


def _order_versions(spark, folder):
    """Photo rows of orders: an early version, and a later one that also counts line items."""
    orders = star.table(spark, folder, "orders")
    lines = star.table(spark, folder, "lineitem")
    counted = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("likes"))
    early = orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("updated_at"),
        F.lit(0).cast("bigint").alias("likes"),
        F.col("o_orderstatus").alias("description"),
        F.col("o_orderdate").alias("extracted_at"),
    )
    late = orders.join(counted, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("updated_at"),
        "likes",
        F.col("o_orderpriority").alias("description"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("extracted_at"),
    )
    return early, late


def _early(df):
    return df.where(F.col("extracted_at") < F.lit("1999-01-01").cast("timestamp_ntz"))


@query
def upsert_photos(spark, folder):
    """The table of photos before 1999, upserted with both versions of nine photos in ten."""
    early, late = _order_versions(spark, folder)
    order = [F.desc("updated_at"), F.asc("description")]
    batch = upsert.latest(early.unionByName(late), ["id"], order)
    batch = batch.where(F.col("id").cast("bigint") % 10 != 3)
    return upsert.upsert(_early(early), batch, ["id"], keep=["extracted_at"])


@query
def touch_updated_at(spark, folder):
    early, late = _order_versions(spark, folder)
    now = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")
    late = late.where(F.col("id").cast("bigint") % 10 != 3)
    return upsert.upsert(_early(early), late, ["id"], touch={"updated_at": now})


def _trends(spark, folder):
    return search.search_trends(star.table(spark, folder, "events"), "event_type", "ts")


@query
def upsert_search_trends(spark, folder):
    """A first count of strong events only, replaced by the full count from 15 January on."""
    events = star.table(spark, folder, "events")
    first = search.search_trends(events.where("value > 50"), "event_type", "ts")
    batch = _trends(spark, folder).where(F.col("trend_date") >= X.day("2024-01-15"))
    return upsert.upsert(first, batch, schemas.KEYS["search_trends"])


@query
def stat_deltas(spark, folder):
    return snapshots.stat_deltas(star.statistics(spark, folder), tie="id")


@query
def stat_deltas_incremental(spark, folder):
    """Snapshots loaded in three parts, one of them twice, through the stored tables."""
    root = scratch(spark, "statistics")
    rows = star.statistics(spark, folder)
    rows = rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    days = ["2024-01-01", "2024-01-10", "2024-01-20", "2025-01-01"]
    for n in (0, 1, 1, 2):
        low, high = (F.lit(d).cast("timestamp") for d in days[n : n + 2])
        part = rows.where((F.col("recorded_at") >= low) & (F.col("recorded_at") < high))
        elt.load_statistics(part.drop("id"), root, F.lit(RECORDED + dt.timedelta(days=n)))
    stored = tables.read_table(spark, root, "photo_statistics").drop("recorded_on")
    return _ntz(stored, "recorded_at")


@query
def stat_deltas_late(spark, folder):
    """Snapshots loaded in four parts that interleave in time, the second of them twice."""
    root = scratch(spark, "late-statistics")
    rows = star.statistics(spark, folder)
    rows = rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    for n, part in enumerate((2, 0, 0, 3, 1)):
        own = rows.where(F.pmod(F.xxhash64("id"), F.lit(4)) == part).drop("id")
        elt.load_statistics(own, root, F.lit(RECORDED + dt.timedelta(days=n)))
    stored = tables.read_table(spark, root, "photo_statistics").drop("recorded_on")
    return _ntz(stored, "recorded_at")


@query
def upsert_analysis(spark, folder):
    """Yesterday's and today's tag analysis in one table: today is rewritten by a second run,
    yesterday and tags that vanished stay."""
    root = scratch(spark, "analysis")
    parts = star.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"),
        F.col("p_size").cast("bigint").alias("likes"),
        F.floor("p_retailprice").alias("downloads"),
        F.lit(0).cast("bigint").alias("views"),
        F.split(F.concat_ws(" ", "p_name", "p_type"), " ").alias("tags"),
    )
    first = tags.tag_analysis(tags.photo_bags(parts), "2001-07-31")
    again = checkpointed(tags.tag_analysis(_stg_bags(spark, folder), AS_OF))
    vanished = again.withColumn("tag_name", F.concat(F.lit("old "), "tag_name"))
    keys = schemas.KEYS["tag_analysis"]
    for batch in (first, vanished, again):
        table = tables.merge(batch, root, "tag_analysis", keys, "analysis_date")
    return table


# -- staging and analytics ---------------------------------------------------------------


@query
def stg_photos(spark, folder):
    return _stg(spark, folder).drop("tags")


@query
def tag_metrics(spark, folder):
    return tags.tag_metrics(_stg_bags(spark, folder), AS_OF)


def _loaded_cells(spark, folder):
    """Photos in three loads, two photos in three first with other tags, likes and days, with the
    cells refreshed after each."""
    root = scratch(spark, "cells")
    photos = star.photos(spark, folder).withColumn("created_at", F.col("created_at").cast("timestamp"))
    photos = checkpointed(elt.conform(photos, schemas.PHOTOS))
    share = F.pmod(F.xxhash64("id"), F.lit(3))
    before = photos.withColumns({
        "likes": F.col("likes") * 2 + 1,
        "tags": F.concat(F.reverse("tags"), F.array(F.lit("old"), F.get("tags", F.lit(0)))),
        "created_at": F.col("created_at") - F.expr("interval 36 hours") * share,
    })
    loads = (
        before.where(share < 2),
        photos.where(share > 0),
        photos.where(share == 0).unionByName(before.where(share == 5)),
    )
    for n, load in enumerate(loads):
        stamp = F.lit(RECORDED + dt.timedelta(days=n))
        tables.add_changes(load, root, "photos", stamp)
        incremental.refresh(spark, root)
    return root


@query
def tag_metrics_incremental(spark, folder):
    """Tag metrics of cells that three loads have filled and changed."""
    stored = incremental.read(spark, _loaded_cells(spark, folder), incremental.TAGS)
    return _ntz(cells.tag_metrics(stored, AS_OF), "first_photo_date", "latest_photo_date")


@query
def tag_pair_rate_incremental(spark, folder):
    root = _loaded_cells(spark, folder)
    tag_cells, pair_cells = (
        incremental.read(spark, root, name) for name in (incremental.TAGS, incremental.PAIRS)
    )
    return cells.tag_pair_rate(tag_cells, pair_cells, AS_OF)


@query
def tag_pairs_positional_incremental(spark, folder):
    stored = incremental.read(spark, _loaded_cells(spark, folder), incremental.PAIRS)
    return cells.tag_pairs_positional(stored, AS_OF)


@query
def tag_cooccurrence_pruned(spark, folder):
    """Pairs on at least 5 photos, with rare tags and light buckets of pairs left out before."""
    bags = cooccurrence.pruned(_stg_bags(spark, folder), 5)
    return cooccurrence.tag_cooccurrence(bags, AS_OF, 5, buckets=1 << 16)


@query
def tag_analysis(spark, folder):
    return tags.tag_analysis(_stg_bags(spark, folder), AS_OF)


@query
def photographer_metrics(spark, folder):
    return photographers.photographer_metrics(_stg(spark, folder), AS_OF)


@query
def photographer_analysis(spark, folder):
    return photographers.photographer_analysis(star.photos(spark, folder), AS_OF)


@query
def daily_stats(spark, folder):
    return daily.daily_stats(_stg(spark, folder))


@query
def daily_top_tags(spark, folder):
    return daily.daily_top_tags(_stg_bags(spark, folder))


@query
def daily_top_colors(spark, folder):
    return daily.daily_top_colors(star.photos(spark, folder))


def _json(df):
    return df.withColumns({c: F.to_json(c) for c in ("top_tags", "top_colors")})


@query
def mart_daily_trends(spark, folder):
    return _json(daily.mart_daily_trends(_stg(spark, folder), _stg_bags(spark, folder)))


@query
def write_mart(spark, folder):
    """The daily mart rebuilt as a table and read back."""
    mart = daily.mart_daily_trends(_stg(spark, folder), _stg_bags(spark, folder))
    return _json(tables.publish(mart, "mart_daily_trends", "table", scratch(spark, "marts")))


def _daily(spark, folder):
    return daily.daily_trends(star.photos(spark, folder), _stg_bags(spark, folder))


@query
def daily_trend_for_day(spark, folder):
    """The daily trend row, computed for every day."""
    return _json(_daily(spark, folder))


@query
def tag_cooccurrence(spark, folder):
    return cooccurrence.tag_cooccurrence(_stg_bags(spark, folder), AS_OF)


@query
def tag_pair_rate(spark, folder):
    return cooccurrence.tag_pair_rate(_stg_bags(spark, folder), AS_OF).select(
        "tag1", "tag2", "cooccurrence_count", "tag1_cooccurrence_rate"
    )


@query
def cooccurrence_ranks(spark, folder):
    return cooccurrence.mart_tag_cooccurrence(_stg_bags(spark, folder), AS_OF)


@query
def cooccurrence_ranks_by_ranges(spark, folder):
    """The same mart; every size is ranked by sorted ranges."""
    return cooccurrence.mart_tag_cooccurrence(_stg_bags(spark, folder), AS_OF)


@query
def tag_pairs_positional(spark, folder):
    return cooccurrence.tag_pairs_positional(_stg_bags(spark, folder), AS_OF)


@query
def co_occurring_tags(spark, folder):
    pairs = cooccurrence.tag_cooccurrence(_stg_bags(spark, folder), AS_OF)
    return cooccurrence.co_occurring_tags(pairs, 5)


@query
def favorite_tags(spark, folder):
    return tags.favorite_tags(_stg_bags(spark, folder), 5)


# -- reads ---------------------------------------------------------------------------------


@query
def photo_count(spark, folder):
    return reads.photo_count(star.photos(spark, folder))


def _page(rows, pagination):
    return rows.withColumns(
        {c: pagination.select(c).scalar() for c in ("total", "has_next")}
    )


@query
def list_photos(spark, folder):
    photos = _normalized(spark, folder)
    rows = reads.list_photos(photos, "views", limit=20, offset=40)
    flat = rows.select(
        "id", "description", "width", "height", "color", "likes", "downloads", "views",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("user.id").alias("user_id"), F.col("user.username").alias("username"),
        F.col("user.name").alias("name"), _csv("tags").alias("tags"),
    )
    return _page(flat, reads.pagination(photos, 20, 40))


@query
def list_photos_deep_page(spark, folder):
    """A page far behind the first, by rank."""
    rows = reads.list_photos_deep(_normalized(spark, folder), "views", limit=50, offset=700)
    return rows.select("id", "views", "likes", F.col("user.username").alias("username"))


@query
def list_photos_selected(spark, folder):
    """The same page, found by rounds of counting."""
    rows = reads.list_photos_selected(_normalized(spark, folder), "views", limit=50, offset=700)
    return rows.select("id", "views", "likes", F.col("user.username").alias("username"))


@query
def photo_detail(spark, folder):
    """Every photo with its latest statistics."""
    detail = reads.photo_detail(
        star.photos(spark, folder), star.statistics(spark, folder), tie="id"
    )
    latest = "latest_statistics"
    return detail.select(
        "id", "width", "height", "color", "likes", "views", "created_at",
        F.col("user.username").alias("username"),
        F.col(f"{latest}.likes").alias("latest_likes"),
        F.col(f"{latest}.downloads").alias("latest_downloads"),
        F.col(f"{latest}.views").alias("latest_views"),
        F.col(f"{latest}.recorded_at").alias("recorded_at"),
    )


@query
def recent_search_trends(spark, folder):
    return reads.recent_search_trends(_trends(spark, folder), LOG_AS_OF)


@query
def top_tags(spark, folder):
    analysis = tags.tag_analysis(_stg_bags(spark, folder), AS_OF)
    return reads.top_tags(analysis, AS_OF)


@query
def top_photographers(spark, folder):
    analysis = photographers.photographer_analysis(star.photos(spark, folder), AS_OF)
    return reads.top_photographers(analysis, AS_OF, "avg_likes_per_photo")


@query
def recent_daily_trends(spark, folder):
    return _json(reads.recent_daily_trends(_daily(spark, folder), AS_OF))


@query
def top_tag_pairs(spark, folder):
    pairs = cooccurrence.tag_pairs_positional(_stg_bags(spark, folder), AS_OF)
    return reads.top_tag_pairs(pairs, AS_OF)


@query
def overview_stats(spark, folder):
    one = reads.overview(star.photos(spark, folder), star.jobs(spark, folder), AS_OF)
    top, job = "top_photo", "latest_etl_job"
    return one.select(
        "total_photos", "total_photographers", "recent_photos_7_days",
        F.col(f"{top}.id").alias("top_id"), F.col(f"{top}.likes").alias("top_likes"),
        F.col(f"{top}.user_username").alias("top_username"),
        *[F.col(f"{job}.{c}").alias(c)
          for c in ("job_name", "status", "started_at", "completed_at", "records_processed")],
    )


@query
def search_photos(spark, folder):
    photos = star.text_photos(spark, folder)
    rows = reads.search_photos(photos, "tHe", limit=20, offset=5)
    flat = rows.select(
        "id", F.md5("description").alias("description_md5"), "likes", "downloads",
        F.col("user.username").alias("username"), F.col("user.name").alias("name"),
    )
    matches = reads.search_matches(photos, "tHe")
    return _page(flat, reads.pagination(matches, 20, 5))


@query
def search_photos_indexed(spark, folder):
    """The same search by the index, which two loads have filled; the second has new versions."""
    root = scratch(spark, "search-index")
    photos = star.text_photos(spark, folder)
    late = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    before = photos.withColumn("description", F.reverse("description"))
    first = photos.where(~late).unionByName(before.where(late))
    search_index.add(first, root, F.lit(RECORDED), blocks=16)
    search_index.add(photos.where(late), root, F.lit(RECORDED + dt.timedelta(days=1)), blocks=16)
    flat = search_index.search_photos(spark, root, "tHe", limit=20, offset=5).select(
        "id", F.md5("description").alias("description_md5"), "likes", "downloads",
        F.col("user.username").alias("username"), F.col("user.name").alias("name"),
    )
    matches = search_index.matches(spark, root, "tHe")
    return _page(flat, reads.pagination(matches, 20, 5))


# -- dashboard tables ----------------------------------------------------------------------


@query
def histogram(spark, folder):
    return charts.histogram(_stg(spark, folder), "likes")


@query
def histogram_of_page(spark, folder):
    """The histogram of the fifty most liked photos, which a dashboard shows."""
    return charts.histogram(_stg(spark, folder), "likes", top_n=50)


@query
def color_counts(spark, folder):
    return charts.color_counts(star.photos(spark, folder))


@query
def top_photos_table(spark, folder):
    return charts.top_photos_table(star.text_photos(spark, folder))


@query
def nlargest_tags(spark, folder):
    analysis = tags.tag_analysis(_stg_bags(spark, folder), AS_OF)
    return charts.nlargest_tags(analysis, "avg_downloads", top=10, top_n=20)


@query
def tag_pair_labels(spark, folder):
    pairs = cooccurrence.tag_pairs_positional(_stg_bags(spark, folder), AS_OF)
    return charts.tag_pair_labels(pairs)


@query
def daily_search_activity(spark, folder):
    return charts.daily_search_activity(_trends(spark, folder))


@query
def data_freshness(spark, folder):
    return charts.data_freshness(
        {
            "photos": (star.table(spark, folder, "orders"), "o_orderdate"),
            "photo_tags": (star.table(spark, folder, "lineitem"), "l_shipdate"),
            "photo_statistics": (star.table(spark, folder, "events"), "ts"),
        },
        LOG_AS_OF,
    )


@query
def data_completeness(spark, folder):
    return charts.data_completeness(_with_first_tag(spark, folder))


# -- maintenance and quality ---------------------------------------------------------------


@query
def dedup_latest(spark, folder):
    return maintenance.dedup_latest(star.users(spark, folder))


@query
def dedup_applied(spark, folder):
    """The users table after its cleanup, a second one, and a fold."""
    root = scratch(spark, "users")
    users = star.users(spark, folder)
    users = users.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    tables.add_changes(users, root, "users", F.lit(RECORDED))
    for n in (1, 2):
        elt.cleanup_users(spark, root, RECORDED + dt.timedelta(days=n))
    tables.fold(spark, root, "users", ["id"], 8, elt.USER_ORDER)
    return _ntz(elt.read_users(spark, root), "updated_at")


@query
def dedup_log(spark, folder):
    return maintenance.dedup_log(star.users(spark, folder))


@query
def dedup_removed(spark, folder):
    return maintenance.dedup_removed(star.users(spark, folder))


@query
def dedup_counts(spark, folder):
    return maintenance.dedup_counts(star.users(spark, folder))


@query
def cleanup_summary(spark, folder):
    return maintenance.cleanup_summary(star.cleanup_logs(spark, folder))


@query
def row_filter(spark, folder):
    return maintenance.row_filter(star.text_photos(spark, folder), "user_username", "src1").select(
        "id", "user_name", "user_username", "likes", F.md5("description").alias("description_md5")
    )


@query
def check_unique(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    return quality.check_unique(lines, ["l_orderkey", "l_linenumber"])


@query
def check_not_null(spark, folder):
    photos = _with_first_tag(spark, folder)
    return quality.check_not_null(photos, photos.columns)


@query
def check_foreign_key(spark, folder):
    """Photo ids that no statistics row refers to."""
    photos = star.photos(spark, folder)
    return quality.check_foreign_key(
        photos, "id", star.statistics(spark, folder).select("photo_id"), "photo_id"
    )


@query
def check_foreign_key_statistics(spark, folder):
    """Photos that statistics rows refer to and that are not among those ever viewed."""
    viewed = star.photos(spark, folder).where("views > 0")
    return quality.check_foreign_key(star.statistics(spark, folder), "photo_id", viewed, "id")


@query
def store_failures(spark, folder):
    """The failing rows of two checks, written and read back."""
    lines = star.table(spark, folder, "lineitem")
    orders = star.table(spark, folder, "orders")
    empty = quality.orphans(orders, "o_orderkey", lines, "l_orderkey")
    checks = {
        "unique_lines": quality.check_unique(lines, ["l_orderkey", "l_linenumber"]),
        "orders_without_lines": empty.select("o_orderkey", "o_orderstatus"),
    }
    return elt.store_failures(checks, scratch(spark, "failures"))


@query
def evolve_schema(spark, folder):
    """A tag analysis written without its later columns, read back and completed."""
    root = scratch(spark, "evolve")
    analysis = tags.tag_analysis(_stg_bags(spark, folder), AS_OF)
    old = tables.publish(analysis, "tag_analysis", "table", root)
    columns = {
        "trend_score": "double", "updated_at": "timestamp_ntz", "co_occurring_tags": "array<string>"
    }
    stamp = F.lit(AS_OF).cast("timestamp_ntz")
    new = maintenance.evolve(old, columns, {"updated_at": stamp})
    assert not maintenance.missing_columns(new, list(columns))
    return new.withColumn("co_occurring_tags", _csv("co_occurring_tags"))


# -- the job -------------------------------------------------------------------------------


def _landing(spark, folder):
    root = scratch(spark, "landing")
    star.raw_lines(spark, folder).write.text(f"{root}/photos")
    star.table(spark, folder, "events").select(
        F.col("event_type").alias("search_term"), F.col("ts").alias("searched_at")
    ).write.json(f"{root}/searches")
    return root


@query
def elt_run(spark, folder):
    """The whole job on raw files of every order and event: one summary row per step."""
    root = scratch(spark, "warehouse")
    return elt.run_elt(spark, _landing(spark, folder), root, AS_OF, recorded_at=RECORDED)


@query
def tag_analysis_table(spark, folder):
    """The analysis of raw files of every order as the job stores it, undeclared values NULL."""
    root = scratch(spark, "warehouse")
    elt.run_elt(
        spark, _landing(spark, folder), root, AS_OF, recorded_at=RECORDED, buckets=8, compact=True
    ).collect()
    return tables.read_table(spark, root, "tag_analysis").select(
        "tag_name", "photo_count", "total_likes", "avg_likes", "analysis_date",
        F.col("updated_at").isNotNull().alias("updated"), "trend_score",
        _csv("co_occurring_tags").alias("co_occurring_tags"),
    )


@query
def photos_after_two_loads(spark, folder):
    """Two overlapping loads, the first one folded: raw records of all orders, then every second
    order again with another like."""
    root = scratch(spark, "loads")
    raw = star.raw_photos(spark, folder)
    elt.load_photos(raw, root, RECORDED)
    elt.fold_tables(spark, root, 8)
    again = raw.where(F.col("id").cast("bigint") % 2 == 0)
    again = again.withColumn("likes", F.col("likes") + 1)
    elt.load_photos(again, root, RECORDED + dt.timedelta(days=1))
    photos = elt.read_photos(spark, root)
    return _ntz(photos, "created_at", "extracted_at").select(
        "id", "created_at", "width", "likes", "extracted_at", _csv("tags").alias("tags")
    )


@query
def quarantine(spark, folder):
    """What two loads of the same cut files and log lines leave in quarantine."""
    root, files = scratch(spark, "quarantine"), scratch(spark, "landing")
    lines = star.table(spark, folder, "events").select(
        F.when(F.col("event_id") % 50 == 0, F.concat(F.lit('{"cut": '), "event_id"))
        .when(F.col("event_id") % 51 == 0, F.to_json(F.struct("ts", "event_id")))
        .otherwise('{"search_term": "x", "searched_at": "2024-01-01T00:00:00Z"}')
        .alias("value")
    )
    raw = landing.read_photos(spark, _packed(spark, star.raw_lines(spark, folder), f"{files}/photos"))
    log = elt.read_search_log(spark, _packed(spark, lines, f"{files}/log"))
    for _ in range(2):
        elt.load_photos(raw, root, RECORDED)
        elt.load_search_trends(log, root, RECORDED)
    remove(spark, files)
    kept = tables.read_table(spark, root, "quarantine")
    return kept.groupBy("feed", "reason", "recorded_on").agg(
        F.count("id").alias("ids"), F.countDistinct(normalize.CORRUPT).alias("texts"),
        F.sum("lines").alias("lines"),
    )


@query
def ingest_photo_batch(spark, folder):
    """The hundred newest loadable records of a feed with several offsets, and all others."""
    raw = landing.read_photos(spark, _landed_photos(spark, folder))
    return landing.photo_batch(raw, 100).select("id", normalize.CORRUPT, "reason")


@query
def job_log(spark, folder):
    """The run log that loading every raw record leaves."""
    root, files = scratch(spark, "warehouse"), _landing(spark, folder)
    log = elt.read_search_log(spark, f"{files}/searches")
    raw = landing.read_photos(spark, f"{files}/photos")
    load = {
        "load_photos": lambda: elt.load_photos(raw, root, RECORDED),
        "load_trending_data": lambda: elt.load_search_trends(log, root, RECORDED),
    }
    for name, step in load.items():
        elt.run_step(spark, root, name, "load", step)
    return tables.read_table(spark, root, "etl_jobs").select(
        "job_name", "job_type", "status", "records_processed", "error_message",
        F.col("completed_at").isNotNull().alias("ended"),
    )


@query
def stream_upsert_photos(spark, folder):
    """The landing files loaded as a stream, twice: the table is as after one load."""
    root, path = scratch(spark, "stream"), scratch(spark, "landing-photos")
    _packed(spark, star.raw_lines(spark, folder), path)
    for name in ("first", "again"):
        stream_photos(spark, path, root, f"{root}/_{name}", RECORDED).awaitTermination()
    remove(spark, path)
    photos = elt.read_photos(spark, root)
    return _ntz(photos, "created_at").select(
        "id", "created_at", "width", "height", "color", "likes", "views", "user_id",
        _csv("tags").alias("tags"),
    )
