"""The batch job: landing files to tables, analyses and marts, with a run log.

    python -m shutterlake.plans.elt --landing DIR --root DIR [--analysis-date D]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import threading
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shutterlake import schemas
from shutterlake.functions import columns as X
from shutterlake.operators import cells, cooccurrence, daily, maintenance, normalize
from shutterlake.operators import photographers, quality
from shutterlake.operators import search, snapshots, staging, tags
from shutterlake.operators.upsert import latest
from shutterlake.plans import graph, incremental
from shutterlake.session import checkpointed, get_session, staged
from shutterlake.sources import landing as L
from shutterlake.sources import ledger, tables

BUCKETS = 64  # hash buckets of the photos table; a layout choice made once per table
LAST = "photo_last_statistics"
DAYS = "photo_statistics_days"
PARTITIONS = {
    "photos": tables.BUCKET,
    LAST: tables.BUCKET,
    DAYS: tables.BUCKET,
    "photo_statistics": "recorded_on",
    "quarantine": "recorded_on",
    "search_trends": "trend_date",
    "tag_analysis": "analysis_date",
    "tag_cooccurrence": "analysis_date",
    "photographer_analysis": "analysis_date",
    "daily_trends": "trend_date",
}


LOG = threading.Lock()


def job_log(
    spark: SparkSession,
    root: str,
    job_name: str,
    job_type: str,
    status: str,
    records: int = 0,
    error: str | None = None,
    meta: dict[str, str] | None = None,
) -> None:
    """Appends one run-log row. A job leaves two: 'running', then 'completed' or 'failed'."""
    ended = F.current_timestamp() if status in ("completed", "failed") else F.lit(None)
    pairs = [F.lit(str(part)) for item in (meta or {}).items() for part in item]
    values = {
        "job_name": F.lit(job_name),
        "job_type": F.lit(job_type),
        "status": F.lit(status),
        "started_at": F.current_timestamp(),
        "completed_at": ended,
        "records_processed": F.lit(records),
        "error_message": F.lit(error),
        "meta_data": F.create_map(*pairs),
    }
    types = StructType.fromDDL(schemas.ETL_JOBS)
    row = [values[f.name].cast(f.dataType).alias(f.name) for f in types]
    with LOG:  # steps run at the same time, but two writers of one folder would lose rows
        tables.append(spark.range(1).coalesce(1).select(*row), root, "etl_jobs")


def run_step(
    spark: SparkSession, root: str, name: str, kind: str, step: Callable[[], int], meta=None
) -> int:
    """Runs ``step``, which returns a record count, between its two log rows."""
    job_log(spark, root, name, kind, "running", meta=meta)
    try:
        records = step()
    except Exception as error:
        job_log(spark, root, name, kind, "failed", error=str(error), meta=meta)
        raise
    job_log(spark, root, name, kind, "completed", records, meta=meta)
    return records


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with the declared columns in their order; those it lacks are NULL."""
    return df.to(StructType.fromDDL(ddl))


def quarantine(bad: DataFrame, feed: str, root: str, recorded_at: dt.datetime) -> None:
    """Keeps records that cannot be loaded, once for each day, whatever repeats."""
    fields = [c for c in bad.columns if c not in (normalize.CORRUPT, "reason")]
    record = F.coalesce(normalize.CORRUPT, F.to_json(F.struct(*fields)))
    name = F.col("id") if "id" in bad.columns else F.lit(None)
    rows = (
        bad.select(
            F.lit(feed).alias("feed"),
            name.cast("string").alias("id"),
            normalize.CORRUPT,
            "reason",
            F.xxhash64(record).alias("fingerprint"),
            F.to_date(F.lit(recorded_at).cast("timestamp")).alias("recorded_on"),
        )
        .groupBy("feed", "fingerprint", "recorded_on")
        .agg(
            *[F.min(c).alias(c) for c in ("id", normalize.CORRUPT, "reason")],
            F.count("*").alias("lines"),
        )
    )
    keys = ["feed", "fingerprint", "recorded_on"]
    with staged(bad.sparkSession) as stage:
        rows = stage(conform(rows, schemas.QUARANTINE))
        tables.merge(rows, root, "quarantine", keys, "recorded_on")


PHOTO_ORDER, PHOTO_KEPT = ["updated_at"], ["extracted_at"]
LAST_ORDER = ["recorded_at"]


def read_photos(spark: SparkSession, root: str) -> DataFrame | None:
    """The photos table with all loads applied."""
    return tables.read_keyed(spark, root, "photos", ["id"], PHOTO_ORDER, PHOTO_KEPT)


def fold_tables(spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
    """Folds the loads since the last time into the bucketed tables."""
    if tables.read_table_or_none(spark, root, incremental.LEDGER) is not None:
        incremental.refresh(spark, root)  # cells take in changes from where they lie
    tables.fold(spark, root, "photos", ["id"], buckets, PHOTO_ORDER, PHOTO_KEPT)
    tables.fold(spark, root, LAST, ["photo_id"], buckets, LAST_ORDER)
    fold_days(spark, root)


def recover_tables(spark: SparkSession, root: str) -> None:
    """Finishes merges that an earlier run left half done."""
    for name, partition in PARTITIONS.items():
        tables.recover(spark, root, name, partition)


def load_photos(raw: DataFrame, root: str, recorded_at: dt.datetime) -> int:
    """Appends good records to photos, merges their snapshots, quarantines the rest.

    Records that are not judged yet are parsed and staged once, for both kinds of reader.
    """
    spark, stamp = raw.sparkSession, F.lit(recorded_at).cast("timestamp")
    with staged(spark) as keep:
        with staged(spark) as stage:
            if "reason" not in raw.columns:
                raw = stage(normalize.judge(raw))
            good, bad = normalize.split_bad(raw)
            quarantine(bad, "photos", root, recorded_at)
            good = good.withColumn("_fingerprint", F.xxhash64(F.to_json(F.struct(*good.columns))))
            newest = [F.desc(X.parse_ts("updated_at")), F.asc("_fingerprint")]
            batch = keep(latest(good, ["id"], newest).drop("_fingerprint"))
        photos = conform(normalize.normalize_photos(batch, stamp), schemas.PHOTOS)
        tables.add_changes(photos, root, "photos", stamp)
        load_statistics(snapshots.photo_statistics(batch, stamp), root, stamp)
        return batch.count()


def load_statistics(new: DataFrame, root: str, loaded_at: Column) -> None:
    """Merges snapshots with their deltas, in whatever order they come.

    A snapshot newer than the photo's newest is compared with that one, which is remembered, so
    the history is not read. For others, late or delivered again, the history is read on their
    own days and the nearest days before and after with snapshots of the photo; the deltas of
    their successors are rewritten with theirs. Which days those are is kept as bits in a table
    of its own, of which only the photos' hash buckets are read. Photo and time must be unique
    in ``new``. A load that broke off is made good by repeating it.
    """
    spark = new.sparkSession
    with staged(spark) as stage:
        new = stage(new)
        last = tables.read_keyed(spark, root, LAST, ["photo_id"], LAST_ORDER)
        if last is None:
            last = spark.createDataFrame([], StructType.fromDDL(schemas.PHOTO_LAST_STATISTICS))
        last = stage(last.join(new, "photo_id", "left_semi").select(*new.columns))
        newest = last.select("photo_id", F.col("recorded_at").alias("_last"))
        late = new.join(newest, "photo_id").where(F.col("recorded_at") <= F.col("_last"))
        known = last
        if not late.isEmpty():
            beside = history_beside(spark, root, late, stage)
            known = known.unionByName(beside.select(*new.columns)).dropDuplicates(snapshots.KEY)
            known = stage(known)  # before the deltas, so that its shuffle files have gone
        deltas = conform(snapshots.placed_deltas(known, new), schemas.PHOTO_STATISTICS)
        deltas = deltas.withColumn("recorded_on", F.to_date("recorded_at"))
        keys = schemas.KEYS["photo_statistics"]
        tables.merge(stage(deltas), root, "photo_statistics", keys, "recorded_on")
        add_days(new, root)
        fresh = snapshots.latest_snapshots(new).join(newest, "photo_id", "left")
        fresh = fresh.where("_last is null or recorded_at >= _last")
        fresh = conform(fresh, schemas.PHOTO_LAST_STATISTICS)
        tables.add_changes(fresh, root, LAST, loaded_at)


def add_days(snaps: DataFrame, root: str) -> None:
    """Appends the days of snapshots; a bucket's rows meet first, else every task has files in all."""
    days = tables.with_bucket(snapshots.days_of(snaps), "photo_id", BUCKETS)
    days = days.hint("rebalance", tables.BUCKET)
    days.write.mode("append").partitionBy(tables.BUCKET).parquet(f"{root.rstrip('/')}/{DAYS}")


def history_beside(
    spark: SparkSession,
    root: str,
    late: DataFrame,
    stage: Callable[[DataFrame], DataFrame] = checkpointed,
) -> DataFrame:
    """The stored snapshots on the days beside late ones, read from those days alone."""
    history = tables.read_table(spark, root, "photo_statistics")
    days = tables.read_table_or_none(spark, root, DAYS)
    if days is None:  # a table that was loaded before its days were kept
        add_days(history, root)
        days = tables.read_table(spark, root, DAYS)
    # at most one row for every bucket, then one for every day of the calendar
    buckets = tables.with_bucket(late.select("photo_id"), "photo_id", BUCKETS)
    buckets = [r[0] for r in buckets.select(tables.BUCKET).distinct().collect()]
    own = days.where(F.col(tables.BUCKET).isin(buckets))
    beside = stage(snapshots.days_beside(own, late))
    on = [r[0] for r in beside.select("recorded_on").distinct().collect()]
    return history.where(F.col("recorded_on").isin(on)).join(
        beside, ["photo_id", "recorded_on"], "left_semi"
    )


def fold_days(spark: SparkSession, root: str) -> None:
    """One row for each photo and month in the table of days."""
    days = tables.read_table_or_none(spark, root, DAYS)
    if days is not None:
        merged = snapshots.merged_days(days)
        batch = checkpointed(tables.with_bucket(merged, "photo_id", BUCKETS))
        tables.merge(batch, root, DAYS, ["photo_id", "month"], tables.BUCKET)


USER_ORDER = ["updated_at"]


def read_users(spark: SparkSession, root: str) -> DataFrame | None:
    return tables.read_keyed(spark, root, "users", ["id"], USER_ORDER)


def cleanup_users(
    spark: SparkSession,
    root: str,
    recorded_at: dt.datetime,
    references: dict[str, str] | None = None,
) -> int:
    """Takes all users but the newest of each email out of the users table.

    The cleanup log gets a row for each email. ``references`` names tables with a column that
    refers to a user's id: their rows that refer to a removed one are kept in
    ``orphaned_references`` before anything is removed. A second run finds nothing to do.
    """
    users = checkpointed(read_users(spark, root))
    removed = checkpointed(maintenance.dedup_removed(users))
    count = removed.count()
    if not count:
        return 0
    stamp = F.lit(recorded_at).cast("timestamp")
    for name, reference in (references or {}).items():
        children = tables.read_table(spark, root, name)
        found = maintenance.referring(removed, children, reference)
        text = F.to_json(F.struct(*children.columns)).alias("row")
        lost = found.select(
            F.lit(name).alias("table"), F.col(reference).cast("string").alias("removed_id"),
            F.col("kept_id").cast("string").alias("kept_id"), text, stamp.alias("created_at"),
        )
        tables.append(lost, root, "orphaned_references")
    log = maintenance.dedup_log(users).withColumn("created_at", stamp)
    tables.append(conform(log, schemas.CLEANUP_LOGS), root, "cleanup_logs")
    ids = removed.select(F.col("removed_id").alias("id"))
    tables.add_removals(ids, root, "users", stamp)
    return count


def load_search_trends(log: DataFrame, root: str, recorded_at: dt.datetime) -> int:
    """Counts searches per term and day; lines that are no search are quarantined."""
    log = log if "reason" in log.columns else L.judge_log(log)
    with staged(log.sparkSession) as stage:
        good, bad = normalize.split_bad(stage(log))
        quarantine(bad, "searches", root, recorded_at)
        trends = search.search_trends(good, "search_term", "searched_at")
        trends = trends.withColumn("extracted_at", F.lit(recorded_at).cast("timestamp"))
        trends = stage(conform(trends, schemas.SEARCH_TRENDS))
        tables.merge(trends, root, "search_trends", schemas.KEYS["search_trends"], "trend_date")
        return trends.count()


def transform(
    spark: SparkSession, root: str, day: dt.date | str, from_cells: bool = False
) -> list[tuple]:
    """The three analyses of a day and the marts, those at the same time that do not need each
    other. A failing part does not stop the others; the checks of the tables come last. With
    ``from_cells`` the tag analysis adds up cells, which take in the photos that changed.
    """
    photos = read_photos(spark, root)
    if photos is None:
        raise FileNotFoundError(f"there are no photos below {root}")
    if tables.has_changes(spark, root, "photos"):  # read by all steps, applied once
        photos = checkpointed(photos)
    bags = tags.photo_bags(photos)
    stamp = F.current_timestamp()
    declared = dict(schemas.KEYS)

    def merged(df, name, partition, keep=()):
        df = checkpointed(conform(df, getattr(schemas, name.upper())))
        tables.merge(df, root, name, declared[name], partition, keep=keep)
        return df.count()

    def analyze_tags():
        if from_cells:
            incremental.refresh(spark, root)
            found = (incremental.read(spark, root, n) for n in (incremental.TAGS, incremental.PAIRS))
            tag_cells, pair_cells = found
            analysis = cells.tag_analysis(tag_cells, day)
            pairs = cells.tag_pairs_positional(pair_cells, day)
        else:
            analysis = tags.tag_analysis(bags, day)
            pairs = cooccurrence.tag_pairs_positional(bags, day)
        analysis = analysis.withColumn("updated_at", stamp)
        count = merged(analysis, "tag_analysis", "analysis_date")
        merged(pairs, "tag_cooccurrence", "analysis_date")
        return count

    def analyze_photographers():
        analysis = photographers.photographer_analysis(photos, day)
        analysis = analysis.withColumn("updated_at", stamp)
        return merged(
            analysis, "photographer_analysis", "analysis_date", ["username", "full_name"]
        )

    def generate_daily_trends():
        trends = daily.daily_trends(photos, bags, day).withColumn("created_at", stamp)
        return merged(trends, "daily_trends", "trend_date", ["created_at"])

    def build_marts():
        def model(name, kind, make, *needs):
            work = lambda: tables.publish(make(), name, kind, root)
            return {name: graph.Step(work, needs)}

        stg = lambda: staging.stg_photos(photos, day)
        models = {
            **model("stg_photos", "view", stg),
            **model("int_tag_metrics", "view", lambda: tags.tag_metrics(bags, day), "stg_photos"),
            **model(
                "int_photographer_metrics", "view",
                lambda: photographers.photographer_metrics(stg(), day), "stg_photos",
            ),
            **model(
                "mart_daily_trends", "table",
                lambda: daily.mart_daily_trends(stg(), bags), "stg_photos",
            ),
            **model(
                "mart_tag_cooccurrence", "table",
                lambda: cooccurrence.mart_tag_cooccurrence(bags, day), "stg_photos",
            ),
        }
        built = graph.run(spark, models)
        failed = [f"{n}: {e}" for n, e in built.items() if isinstance(e, Exception)]
        if failed:
            raise RuntimeError("; ".join(failed))
        return len(models)

    def test_tables():
        checks = {}
        for name, keys in declared.items():
            df = photos if name == "photos" else tables.read_table_or_none(spark, root, name)
            if df is not None:
                required = schemas.REQUIRED.get(name, keys)
                checks[f"unique_{name}"] = quality.check_unique(df, keys)
                checks[f"not_null_{name}"] = quality.check_not_null(df, required)
        stats = tables.read_table_or_none(spark, root, "photo_statistics")
        if stats is not None:
            lost = quality.check_foreign_key(stats, "photo_id", photos, "id")
            checks["foreign_key_photo_statistics"] = lost
        failures = store_failures(checks, root).count()
        if failures:
            raise ValueError(f"{failures} failing rows, kept in the table failures")
        return failures

    analyses = (analyze_tags, analyze_photographers, generate_daily_trends, build_marts)
    named = {step.__name__: step for step in (*analyses, test_tables)}

    def logged(name):
        return lambda: run_step(spark, root, name, "transform", named[name], {"date": str(day)})

    steps = {step.__name__: graph.Step(logged(step.__name__)) for step in analyses}
    steps["test_tables"] = graph.Step(logged("test_tables"), after=tuple(steps))
    return [
        ("transform", name, False, 0, str(got))
        if isinstance(got, Exception)
        else ("transform", name, True, got, None)
        for name, got in graph.run(spark, steps).items()
    ]


def store_failures(checks: dict[str, DataFrame], root: str) -> DataFrame:
    """Keeps the failing rows of all checks as (check_name, failing), ``failing`` as JSON."""
    parts = [
        failing.select(
            F.lit(name).alias("check_name"), F.to_json(F.struct(*failing.columns)).alias("failing")
        )
        for name, failing in checks.items()
    ]
    return tables.publish(reduce(DataFrame.unionByName, parts), "failures", "table", root)


SUMMARY = "phase string, step string, success boolean, records bigint, error string"


def run_elt(
    spark: SparkSession,
    landing: str,
    root: str,
    analysis_date: dt.date | str,
    batch_size: int | None = None,
    extract_only: bool = False,
    transform_only: bool = False,
    recorded_at: dt.datetime | None = None,
    buckets: int = BUCKETS,
    compact: bool = False,
    only_new: bool = False,
) -> DataFrame:
    """Extract, load and transform; one summary row per step.

    ``landing`` holds the folder photos/ and, optionally, details/ and statistics/, which
    complete the photo records, and searches/, a search log. Load needs a successful
    extract, transform a successful load; a failure keeps what earlier phases wrote. With
    ``compact`` the loads are folded into the tables' ``buckets`` before the transform. An
    run with ``only_new`` parses only photo files that no such run has loaded; if details or
    statistics have landed or changed since, all photo files, as any may be completed by them.
    A batch size would leave out records of files that then count as loaded, so it is refused. Such
    a run also takes its tag analysis from cells.
    """
    if only_new and batch_size is not None:
        raise ValueError("a run of new files takes whole files")
    recover_tables(spark, root)
    recorded_at = recorded_at or dt.datetime.now(dt.timezone.utc)
    results: list[tuple] = []

    def phase(name, step, work):
        try:
            results.append((name, step, True, run_step(spark, root, step, name, work), None))
        except Exception as error:
            results.append((name, step, False, 0, str(error)))
        return results[-1][2]

    def summary():
        return spark.createDataFrame(results, SUMMARY)

    if not transform_only:
        staged = {}

        def extract():
            files = unseen_files(spark, landing, root) if only_new else None
            read = read_records(spark, landing, files)
            judged = checkpointed(normalize.judge(read))
            staged["photos"] = checkpointed(L.photo_batch(judged, batch_size))
            staged["files"] = files
            return staged["photos"].count()

        def load():
            count = load_photos(staged["photos"], root, recorded_at)
            if staged["files"] is not None:
                ledger.record(staged["files"], root)
            return count

        if not phase("extract", "extract_photos", extract) or extract_only:
            return summary()
        loaded = phase("load", "load_photos", load)
        log = read_search_log(spark, f"{landing}/searches")
        if log is not None:
            load_log = lambda: load_search_trends(log, root, recorded_at)
            loaded &= phase("load", "load_trending_data", load_log)
        if not loaded:
            return summary()
    if compact:
        fold_tables(spark, root, buckets)
    results.extend(transform(spark, root, analysis_date, from_cells=only_new))
    return summary()


def unseen_files(spark: SparkSession, landing: str, root: str) -> DataFrame:
    """Photo files to parse, with the files of the feeds that complete them if those are new."""
    found = ledger.unseen(spark, f"{landing}/photos", root)
    for feed in ("details", "statistics"):
        more = or_none(lambda feed=feed: ledger.unseen(spark, f"{landing}/{feed}", root))
        if more is not None and not more.isEmpty():
            every = ledger.landed(spark, f"{landing}/photos")
            found = found.unionByName(more).unionByName(every).distinct()
    return checkpointed(found)


def read_records(
    spark: SparkSession, landing: str, files: DataFrame | None = None
) -> DataFrame:
    """The photo feed, completed by the details and statistics feeds where they landed.

    With ``files`` only those of them that are photo files are parsed.
    """
    if files is None:
        basic = L.read_photos(spark, f"{landing}/photos")
    else:
        own = ledger.landed(spark, f"{landing}/photos").select("path")
        paths = ledger.paths(files.join(own, "path", "left_semi"))
        if not paths:
            return L.empty_feed(spark, "photos")
        basic = L.read_photos(spark, paths)
    details = or_none(lambda: L.read_feed(spark, f"{landing}/details", "photos"))
    stats = or_none(lambda: L.read_feed(spark, f"{landing}/statistics", "photo_statistics"))
    if details is None and stats is None:
        return basic
    if details is None:
        details = basic.limit(0)
    if stats is None:
        found = details.where("statistics is not null").select("id", "statistics.*")
        stats = found.unionByName(basic.where("statistics is not null").select("id", "statistics.*"))
    else:
        stats = _valid(stats)
    text = F.xxhash64(F.to_json(F.struct(*details.columns)))
    newest = [F.desc(X.parse_ts("updated_at")), F.asc(text)]
    details = latest(_valid(details, keep=True), ["id"], newest)
    totals = [F.desc(f"{c}.total") for c in snapshots.DELTAS]  # totals only grow
    return normalize.enrich(basic, details, latest(stats, ["id"], totals))


def _valid(feed: DataFrame, keep: bool = False) -> DataFrame:
    """A feed's well-formed records with an id."""
    valid = feed.where(F.col("id").isNotNull() & F.col(normalize.CORRUPT).isNull())
    return valid if keep else valid.drop(normalize.CORRUPT)


def or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_search_log(spark: SparkSession, path: str) -> DataFrame | None:
    return or_none(lambda: L.read_search_log(spark, path))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Run the photo trends job")
    parser.add_argument("--landing", required=True)
    parser.add_argument("--root", required=True)
    parser.add_argument("--analysis-date", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--batch-size", type=int)
    parser.add_argument("--compact", action="store_true")
    parser.add_argument("--only-new", action="store_true")
    parser.add_argument("--log-level", choices=["DEBUG", "INFO", "WARN", "ERROR"], default="WARN")
    only = parser.add_mutually_exclusive_group()
    only.add_argument("--extract-only", action="store_true")
    only.add_argument("--transform-only", action="store_true")
    args = parser.parse_args(argv)
    spark = get_session()
    spark.sparkContext.setLogLevel(args.log_level)
    summary = run_elt(
        spark,
        args.landing,
        args.root,
        args.analysis_date,
        args.batch_size,
        args.extract_only,
        args.transform_only,
        compact=args.compact,
        only_new=args.only_new,
    )
    rows = summary.collect()  # one row per step
    for row in rows:
        print(*row, sep="\t")
    return 0 if all(row["success"] for row in rows) else 1


if __name__ == "__main__":
    sys.exit(main())
