import datetime as dt
import json
import random
import time
from pathlib import Path

import pytest

from conftest import rows
from pyspark.sql.types import StructType
from shutterlake import schemas
from shutterlake.operators import snapshots
from shutterlake.plans import catalog, elt, graph
from shutterlake.session import shared_folder
from shutterlake.sources import tables
from shutterlake.streaming.ingest import stream_photos

DAY = "2024-12-20"


def at(day):
    return dt.datetime(2024, 12, day, tzinfo=dt.timezone.utc)


def record(i, likes, **fields):
    return {
        "id": f"p{i}", "created_at": "2024-12-20T08:00:00Z", "updated_at": f"2024-12-{likes:02}T00:00:00Z",
        "width": 3, "height": 2, "likes": likes, "views": 100, "color": "#aaaaaa",
        "user": {"id": "u", "name": "N", "username": "n"},
        "tags": [{"title": "a"}, {"title": "b"}], "statistics": {"likes": {"total": likes}},
    } | fields


def drop(folder, name, *records):
    (folder / "photos").mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / "photos" / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    drop(folder, "1.json", record(1, 5), record(2, 6), record(2, 7), '{"cut',
         record(3, 8, width=None))
    (folder / "searches").mkdir()
    (folder / "searches" / "s.json").write_text(
        '{"search_term": "sun", "searched_at": "2024-12-20T01:00:00Z"}\n')
    return folder


def test_job_twice(spark, landing, tmp_path):
    root = str(tmp_path / "tables")
    first = elt.run_elt(spark, str(landing), root, DAY, recorded_at=at(20), buckets=2, compact=True)
    steps = {r["step"]: (r["success"], r["records"]) for r in first.collect()}
    assert steps == {
        "extract_photos": (True, 5), "load_photos": (True, 2), "load_trending_data": (True, 1),
        "analyze_tags": (True, 2), "analyze_photographers": (True, 1),
        "generate_daily_trends": (True, 1), "build_marts": (True, 5), "test_tables": (True, 0)}
    photos = elt.read_photos(spark, root)
    assert rows(photos, "id", "likes", "tags") == [("p1", 5, ["a", "b"]), ("p2", 7, ["a", "b"])]
    bad = tables.read_table(spark, root, "quarantine")
    assert rows(bad, "feed", "reason", "id", "lines") == [
        ("photos", "malformed", None, 1), ("photos", "width", "p3", 1)]
    assert "bucket" not in photos.columns and "bucket" not in spark.table("stg_photos").columns
    seen = rows(photos, "id", "extracted_at")

    drop(landing, "2.json", record(2, 9, color=None), record(4, 1, tags=[{"title": "z"}]))
    (landing / "photos" / "1.json").unlink()
    second = elt.run_elt(spark, str(landing), root, DAY, recorded_at=at(21))
    assert all(r["success"] for r in second.collect())
    photos = elt.read_photos(spark, root)
    assert rows(photos, "id", "likes", "color") == [
        ("p1", 5, "#aaaaaa"), ("p2", 9, None), ("p4", 1, "#aaaaaa")]
    assert rows(photos.where("id <> 'p4'"), "id", "extracted_at") == seen
    stats = tables.read_table(spark, root, "photo_statistics")
    assert rows(stats, "photo_id", "likes", "likes_delta") == [
        ("p1", 5, 5), ("p2", 7, 7), ("p2", 9, 2), ("p4", 1, 1)]
    for name in ("photo_statistics", "search_trends", "tag_analysis", "tag_cooccurrence",
                 "photographer_analysis", "daily_trends"):
        declared = StructType.fromDDL(getattr(schemas, name.upper())).fieldNames()
        assert set(declared) <= set(tables.read_table(spark, root, name).columns)
    analysis = tables.read_table(spark, root, "tag_analysis")
    assert rows(analysis, "tag_name", "photo_count") == [("a", 2), ("b", 2), ("z", 1)]
    log = tables.read_table(spark, root, "etl_jobs")
    assert rows(log.groupBy("status").count()) == [("completed", 16), ("running", 16)]

    repeat = elt.run_elt(spark, str(landing), root, DAY, recorded_at=at(21))
    assert all(r["success"] for r in repeat.collect())
    assert rows(tables.read_table(spark, root, "photo_statistics"), "photo_id", "likes_delta") == [
        ("p1", 5), ("p2", 2), ("p2", 7), ("p4", 1)]


def test_failed_extract_stops_and_is_logged(spark, tmp_path):
    root = str(tmp_path / "tables")
    (tmp_path / "landing" / "photos").mkdir(parents=True)
    drop(tmp_path / "landing", "x.json", '{"id": "p"}')
    got = elt.run_elt(spark, str(tmp_path / "landing"), root, DAY, extract_only=True).collect()
    assert [(r["step"], r["records"]) for r in got] == [("extract_photos", 1)]
    none = elt.run_elt(spark, str(tmp_path / "nowhere"), root, DAY).collect()
    assert [(r["step"], r["success"]) for r in none] == [("extract_photos", False)]

    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        elt.run_step(spark, root, "broken", "load", fail)
    log = tables.read_table(spark, root, "etl_jobs").where("job_name = 'broken'")
    assert rows(log, "status", "error_message") == [("failed", "no"), ("running", None)]


def test_failing_check_is_kept_and_reported(spark, landing, tmp_path):
    root = str(tmp_path / "tables")
    elt.run_elt(spark, str(landing), root, DAY, recorded_at=at(20))
    stats = tables.read_table(spark, root, "photo_statistics").limit(1)
    lost = stats.drop("recorded_on").selectExpr("* except (photo_id)", "'gone' photo_id")
    lost.write.mode("append").parquet(f"{root}/photo_statistics/recorded_on=2024-12-20")
    only = elt.run_elt(spark, "nowhere", root, DAY, transform_only=True).collect()
    assert {r["phase"] for r in only} == {"transform"}
    got = {r["step"]: r for r in only}
    assert got["build_marts"]["success"] and not got["test_tables"]["success"]
    kept = tables.read_table(spark, root, "failures")
    assert rows(kept) == [("foreign_key_photo_statistics", '{"photo_id":"gone","rows":1}')]


def test_details_and_statistics_feeds(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    drop(landing, "1.json", record(1, 5), record(2, 6), '{"cut')
    for feed, lines in (
        ("details", [record(2, 9, color="#bbbbbb"), record(2, 8), record(7, 7), "{bad"]),
        ("statistics", [{"id": "p1", "likes": {"total": 50}}, {"id": "p1", "likes": {"total": 40}}]),
    ):
        (landing / feed).mkdir()
        (landing / feed / "f.json").write_text(
            "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    records = elt.normalize.judge(elt.read_records(spark, str(landing)))
    assert records.where("reason = 'malformed'").count() == 1
    assert elt.load_photos(records, root, at(20)) == 2
    photos = elt.read_photos(spark, root)
    assert rows(photos, "id", "likes", "color") == [("p1", 5, "#aaaaaa"), ("p2", 9, "#bbbbbb")]
    stats = tables.read_table(spark, root, "photo_statistics")
    assert rows(stats, "photo_id", "likes") == [("p1", 50)]


def test_stream_equals_batch(spark, landing, tmp_path):
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    drop(landing, "2.json", record(2, 9), record(5, 3))
    elt.load_photos(elt.L.read_photos(spark, f"{landing}/photos"), batch, at(20))
    for run in ("a", "b"):
        query = stream_photos(spark, f"{landing}/photos", stream, f"{stream}/_{run}", at(20))
        query.awaitTermination()
    assert rows(elt.read_photos(spark, stream), "id", "likes") == rows(
        elt.read_photos(spark, batch), "id", "likes")
    for name, columns in (("quarantine", ("fingerprint", "lines")),
                          ("photo_statistics", ("photo_id", "likes", "likes_delta"))):
        assert rows(tables.read_table(spark, stream, name), *columns) == rows(
            tables.read_table(spark, batch, name), *columns)


def test_newest_is_compared_as_an_instant(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    older, newer = "2024-12-20T01:00:00+05:00", "2024-12-19T23:00:00Z"
    drop(landing, "1.json", record(1, 5))
    (landing / "details").mkdir()
    details = [record(1, 6, updated_at=older), record(1, 7, updated_at=newer)]
    (landing / "details" / "f.json").write_text("\n".join(map(json.dumps, details)))
    elt.load_photos(elt.read_records(spark, str(landing)), root, at(20))
    assert rows(elt.read_photos(spark, root), "likes") == [(7,)]
    drop(landing, "1.json", record(1, 5, created_at=older), record(2, 6, created_at=newer))
    page = elt.L.photo_batch(elt.L.read_photos(spark, f"{landing}/photos"), 1)
    assert rows(page, "id") == [("p2",)]


def test_lines_that_are_no_search(spark, tmp_path):
    root, path = str(tmp_path / "tables"), tmp_path / "log"
    path.mkdir()
    lines = ['{"search_term": "sun", "searched_at": "2024-12-20T01:00:00Z"}', '{"cut',
             '{"search_term": "sea"}', '{"searched_at": "soon"}']
    (path / "s.json").write_text("\n".join(lines))
    for _ in range(2):
        assert elt.load_search_trends(elt.read_search_log(spark, str(path)), root, at(20)) == 1
    assert rows(tables.read_table(spark, root, "search_trends"), "search_term") == [("sun",)]
    bad = tables.read_table(spark, root, "quarantine")
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "malformed", "searched_at"]
    assert elt.read_search_log(spark, str(tmp_path / "nowhere")) is None


def test_statistics_out_of_order_and_twice(spark, tmp_path):
    root = str(tmp_path / "tables")
    schema = "photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint"
    loads = [("p", at(3), 0, 30, 0)], [("p", at(5), 0, 50, 0), ("q", at(5), 0, 7, 0)]
    for data in (*loads, loads[1], [("p", at(4), 0, 40, 0)], [("p", at(6), 0, 61, 0)]):
        elt.load_statistics(spark.createDataFrame(data, schema), root, elt.F.lit(at(9)))
        elt.fold_tables(spark, root, 2)
    stored = tables.read_table(spark, root, "photo_statistics")
    assert rows(stored, "photo_id", "likes", "likes_delta") == [
        ("p", 30, 30), ("p", 40, 10), ("p", 50, 10), ("p", 61, 11), ("q", 7, 7)]


def test_loads_in_any_order_equal_one(spark, tmp_path):
    rng, start = random.Random(4), dt.datetime(2024, 1, 29)
    schema = "photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint"
    times = rng.sample(range(0, 24 * 200, 5), 60)
    data = [(rng.choice("aaab"), start + dt.timedelta(hours=h), rng.randrange(99), i, None)
            for i, h in enumerate(times)]
    loads = [data[20:40], data[:25], data[40:] + data[3:5]]
    for n, load in enumerate(loads):
        elt.load_statistics(spark.createDataFrame(load, schema), str(tmp_path), elt.F.lit(at(9)))
        if n == 1:
            elt.fold_tables(spark, str(tmp_path), 2)
    stored = tables.read_table(spark, str(tmp_path), "photo_statistics").drop("recorded_on")
    whole = snapshots.stat_deltas(spark.createDataFrame(data, schema))
    assert rows(stored) == rows(whole)


def test_only_days_beside_a_late_snapshot_are_read(spark, tmp_path):
    root, schema = str(tmp_path), "photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint"
    day = lambda n, h=0: dt.datetime(2024, 3, 1, h) + dt.timedelta(days=n)
    data = [("p", day(n), n, n, n) for n in (0, 3, 9, 40, 70)] + [("q", day(n), 1, 1, 1) for n in range(60)]
    elt.load_statistics(spark.createDataFrame(data, schema), root, elt.F.lit(at(9)))
    late = spark.createDataFrame([("p", day(20), 5, 5, 5), ("p", day(40, 3), 9, 9, 9)], schema)
    days = snapshots.days_beside(tables.read_table(spark, root, elt.DAYS), late)
    assert rows(days) == sorted([("p", day(n).date()) for n in (9, 40, 70)], key=repr)
    read = elt.history_beside(spark, root, late)
    assert "PartitionFilters: [recorded_on" in read._jdf.queryExecution().toString()
    assert {r["photo_id"] for r in read.collect()} == {"p"}
    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.glob("photo_statistics/*/*.parquet")}
    before = files()
    elt.load_statistics(late, root, elt.F.lit(at(9)))
    kept = {p.parent.name[-10:] for p, t in files().items() if before.get(p) == t}
    assert kept == {str(day(n).date()) for n in range(71) if n not in (20, 40) and (n < 60 or n == 70)} - {str(day(70).date())}


class Session:
    """Stands for a session on a cluster with the given settings."""

    def __init__(self, **settings):
        self.conf = settings
        self.sparkContext = self
        self.master = "yarn"
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) and spark.sparkContext.getCheckpointDir()
    cluster = Session(**{"spark.checkpoint.dir": "hdfs://shared"})
    assert shared_folder(cluster) == "hdfs://shared" == cluster.getCheckpointDir()
    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_a_run_of_new_files_parses_only_those(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    (landing / "photos").mkdir(parents=True)
    write = lambda name, *ids: (landing / "photos" / name).write_text(
        "\n".join(json.dumps(record(i, i)) for i in ids)
    )
    run = lambda: {
        r["step"]: r["records"]
        for r in elt.run_elt(spark, str(landing), root, DAY, extract_only=True, only_new=True).collect()
    }
    write("a.json", 1, 2)
    assert run()["extract_photos"] == 2
    load = lambda: elt.ledger.record(elt.unseen_files(spark, str(landing), root), root)
    load()
    assert run()["extract_photos"] == 0
    write("b.json", 3)
    assert run()["extract_photos"] == 1
    load()
    write("a.json", 1, 2, 4)  # written again
    assert run()["extract_photos"] == 3
    load()
    (landing / "statistics").mkdir()
    (landing / "statistics" / "s.json").write_text('{"id": "p1", "likes": {"total": 7}}')
    assert run()["extract_photos"] == 4  # any photo may be completed
    with pytest.raises(ValueError):
        elt.run_elt(spark, str(landing), root, DAY, batch_size=1, only_new=True)


def test_runs_of_new_files_give_the_analyses_of_full_runs(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "photos").mkdir(parents=True)
    roots = [str(tmp_path / n) for n in ("new", "full")]
    for n, ids in enumerate(((1, 2, 3), (2, 5), ())):
        for i in ids:
            text = json.dumps(record(i, i + 3 * n, tags=[{"title": t} for t in "abc"[: 1 + (i + n) % 3]]))
            (landing / "photos" / f"{n}-{i}.json").write_text(text)
        for root, only_new in zip(roots, (True, False), strict=True):
            run = elt.run_elt(spark, str(landing), root, DAY, recorded_at=at(20 + n), only_new=only_new, compact=n == 1)
            assert all(r["success"] for r in run.collect())
    for name, columns in (("tag_analysis", ("tag_name", "photo_count", "total_likes", "avg_likes")),
                          ("tag_cooccurrence", ("tag1", "tag2", "cooccurrence_count"))):
        one, two = (rows(tables.read_table(spark, root, name), *columns) for root in roots)
        assert one == two and one


def test_a_failed_model_skips_only_what_needs_it(spark):
    order = []
    step = lambda name, *needs, fail=False, after=(): graph.Step(
        lambda: 1 // (not fail) and order.append(name) or spark.range(3).count(), needs, after
    )
    steps = {
        "d": step("d", "b"), "a": step("a"), "b": step("b", "a", fail=True), "c": step("c", "a"),
        "e": step("e", "d"), "last": step("last", after=("d", "c")),
    }
    got = graph.run(spark, steps)
    assert list(got) == list(steps) and [got[n] for n in ("a", "c", "last")] == [3, 3, 3]
    assert isinstance(got["b"], ZeroDivisionError)
    assert all(isinstance(got[n], graph.Skipped) for n in "de")
    assert order[0] == "a" and order.index("c") < order.index("last")
    with pytest.raises(ValueError):
        graph.run(spark, {"x": step("x", "y"), "y": step("y", "x")})
    with pytest.raises(ValueError):
        graph.run(spark, {"x": step("x", "z")})


def test_days_of_a_load_lie_in_a_file_for_each_bucket(spark, tmp_path):
    root, conf = str(tmp_path), "spark.sql.adaptive.coalescePartitions.enabled"
    names = "photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint"
    data = [(str(i), dt.datetime(2024, 1, 1 + i % 5), i, i, i) for i in range(2000)]
    spark.conf.set(conf, "false")  # as on large inputs, many tasks have rows
    try:
        new = spark.createDataFrame(data, names)
        elt.load_statistics(new, root, elt.F.lit(dt.datetime(2024, 2, 1)))
    finally:
        spark.conf.unset(conf)
    files = list((tmp_path / elt.DAYS).glob("*/*.parquet"))
    assert len(files) == elt.BUCKETS
    days = elt.tables.read_table(spark, root, elt.DAYS)
    assert days.agg(elt.F.count("*"), elt.F.sum(elt.F.bit_count("days"))).first() == (2000, 2000)


def star_tables(spark, folder):
    """Orders, customers and events; one order in 23 lands as a cut line, one in 19 has no width."""
    day = dt.datetime(2024, 1, 5)
    orders = [(k, 1 + k % 7, "O", 100.0 + k, day, "1-URGENT") for k in range(1, 461)]
    events = [(k, day, k % 9, "click", 1.0, '{"k": 1}') for k in range(1, 301)]
    for name, data, columns in (
        ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        ("customer", [(k, f"c{k}", "AUTO") for k in range(1, 8)], "c_custkey bigint, c_name string, c_mktsegment string"),
        ("events", events, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"),
    ):
        spark.createDataFrame(data, columns).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def left_over(spark, work):
    """What ``work`` returns, the names of the folders with files that it left, and its shuffles."""
    shared = Path(shared_folder(spark).removeprefix("file:"))
    found = lambda: {p.relative_to(shared).parts for p in shared.rglob("part-*") if p.is_file()}
    manager = spark._jsc.sc().env().blockManager().diskBlockManager()
    blocks = lambda: {b for b in manager.getAllBlocks().mkString(" ").split() if b.startswith("shuffle")}
    files, shuffles = found(), blocks()
    got = work()
    until = time.time() + 20
    while blocks() - shuffles and time.time() < until:  # Spark removes them in the background
        time.sleep(0.2)
    folders = {p[1].rsplit("-", 1)[0] if p[0] == "shutterlake" else p[0] for p in found() - files}
    return got, folders, blocks() - shuffles


def test_quarantine_leaves_nothing_but_its_tables(spark, tmp_path):
    folder = star_tables(spark, tmp_path / "star")
    got, folders, shuffles = left_over(spark, lambda: catalog.QUERIES["quarantine"](spark, folder))
    assert (folders, shuffles) == ({"quarantine"}, set())
    assert rows(got, "feed", "reason", "ids", "texts", "lines") == [
        ("photos", "malformed", 0, 20, 20), ("photos", "width", 23, 0, 23),
        ("searches", "malformed", 0, 6, 6), ("searches", "search_term,searched_at", 0, 0, 5)]


def test_stream_leaves_nothing_but_its_tables(spark, tmp_path):
    folder = star_tables(spark, tmp_path / "star")
    query = catalog.QUERIES["stream_upsert_photos"]
    got, folders, shuffles = left_over(spark, lambda: query(spark, folder))
    assert (folders, shuffles) == ({"stream"}, set())
    good = [k for k in range(1, 461) if k % 19 and k % 23]
    assert rows(got, "id", "views") == sorted(((str(k), 10 + k // 10) for k in good), key=repr)
