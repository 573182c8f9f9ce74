import datetime as dt
import os
import random
import shutil

import pytest

from conftest import rows
from pyspark.sql import functions as F
from shutterlake.operators import snapshots, upsert
from shutterlake.sources import tables

T0 = dt.datetime(2024, 1, 1)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "id string, v bigint, seen string")


def test_upsert(spark):
    current = frame(spark, ("1", 1, "old"), ("2", 2, "old"))
    batch = frame(spark, ("2", None, "new"), ("3", 3, "new"))
    once = upsert.upsert(current, batch, ["id"], keep=["seen"])
    assert rows(once) == [("1", 1, "old"), ("2", None, "old"), ("3", 3, "new")]
    assert rows(upsert.upsert(once, batch, ["id"], keep=["seen"])) == rows(once)
    assert rows(upsert.upsert(current, batch, ["id"])) == [
        ("1", 1, "old"), ("2", None, "new"), ("3", 3, "new")]
    touched = upsert.upsert(current, batch, ["id"], touch={"seen": F.lit("now")})
    assert rows(touched) == [("1", 1, "old"), ("2", None, "now"), ("3", 3, "new")]
    assert rows(upsert.upsert(current, batch.drop("seen"), ["id"])) == [
        ("1", 1, "old"), ("2", None, "old"), ("3", 3, None)]


def test_latest(spark):
    df = frame(spark, ("1", 1, "a"), ("1", 2, "b"), ("1", 2, "a"), ("2", 0, "z"))
    got = upsert.latest(df, ["id"], [F.desc("v"), F.asc("seen")])
    assert rows(got) == [("1", 2, "a"), ("2", 0, "z")]


def test_merge_rewrites_touched_partitions_only(spark, tmp_path):
    root = str(tmp_path)

    def batch(*data):
        return spark.createDataFrame(list(data), "k string, v bigint, day date")

    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tables.merge(batch(("a", 1, one), ("b", 1, one), ("a", 1, two)), root, "t", ["k", "day"], "day")
    untouched = sorted(os.listdir(tmp_path / "t" / "day=2024-01-01"))
    again = batch(("a", 9, two), ("c", 9, two))
    for _ in range(2):
        got = tables.merge(again, root, "t", ["k", "day"], "day")
        assert rows(got, "k", "v", "day") == [
            ("a", 1, one), ("a", 9, two), ("b", 1, one), ("c", 9, two)]
    assert sorted(os.listdir(tmp_path / "t" / "day=2024-01-01")) == untouched
    assert rows(tables.merge(again.limit(0), root, "t", ["k", "day"], "day")) == rows(got)


def test_merge_of_nothing(spark, tmp_path):
    df = tables.with_bucket(frame(spark, ("1", 1, "a")), "id", 2)
    for batch, expected in ((df.limit(0), []), (df.limit(0), []), (df, [("1", 1, "a")]),
                            (df.limit(0), [("1", 1, "a")])):
        got = tables.merge(batch, str(tmp_path), "t", ["id"], tables.BUCKET)
        assert rows(got, "id", "v", "seen") == expected


def test_merge_by_bucket_keeps_first_seen(spark, tmp_path):
    root = str(tmp_path)
    first = tables.with_bucket(frame(spark, *[(str(i), i, "old") for i in range(50)]), "id", 4)
    second = tables.with_bucket(frame(spark, *[(str(i), -i, "new") for i in range(40, 60)]), "id", 4)
    tables.merge(first, root, "p", ["id"], tables.BUCKET, keep=["seen"])
    got = tables.merge(second, root, "p", ["id"], tables.BUCKET, keep=["seen"])
    expected = [(str(i), i, "old") for i in range(40)]
    expected += [(str(i), -i, "old") for i in range(40, 50)]
    expected += [(str(i), -i, "new") for i in range(50, 60)]
    assert rows(got, "id", "v", "seen") == sorted(expected, key=repr)


def test_merge_adds_new_columns(spark, tmp_path):
    root = str(tmp_path)
    first = tables.with_bucket(frame(spark, ("1", 1, "a"), ("2", 2, "a")), "id", 4)
    tables.merge(first, root, "t", ["id"], tables.BUCKET)
    more = tables.with_bucket(frame(spark, ("2", 3, "b")), "id", 4).withColumn("extra", F.lit(7))
    got = tables.merge(more, root, "t", ["id"], tables.BUCKET)
    assert rows(got, "id", "v", "extra") == [("1", 1, None), ("2", 3, 7)]


def test_an_interrupted_exchange_is_finished(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    batch = tables.with_bucket(frame(spark, *[(str(i), i, "a") for i in range(20)]), "id", 4)
    tables.merge(batch, root, "t", ["id"], tables.BUCKET)
    recover = tables.recover
    calls = []

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:  # after staging: partitions are gone, the new ones not there yet
            for part in os.listdir(tmp_path / "t"):
                if part.startswith("bucket="):
                    shutil.rmtree(tmp_path / "t" / part)
            raise OSError("lost")
        return recover(*args)

    monkeypatch.setattr(tables, "recover", broken)
    change = tables.with_bucket(frame(spark, ("3", -3, "b")), "id", 4)
    with pytest.raises(OSError):
        tables.merge(change, root, "t", ["id"], tables.BUCKET)
    monkeypatch.setattr(tables, "recover", recover)
    assert tables.recover(spark, root, "t", tables.BUCKET)
    assert not tables.recover(spark, root, "t", tables.BUCKET)
    touched = rows(change, "bucket")[0][0]
    want = sorted((str(i), -3 if i == 3 else i) for i, b in
                  ((int(r["id"]), r["bucket"]) for r in batch.collect()) if b == touched)
    assert rows(tables.read_table(spark, root, "t"), "id", "v") == want
    assert os.listdir(tmp_path / "_staged") == []


def test_an_incomplete_stage_is_dropped(spark, tmp_path):
    root = str(tmp_path)
    batch = tables.with_bucket(frame(spark, ("1", 1, "a")), "id", 4)
    tables.merge(batch, root, "t", ["id"], tables.BUCKET)
    (tmp_path / "_staged" / "t").mkdir(parents=True)
    assert not tables.recover(spark, root, "t", tables.BUCKET)
    assert rows(tables.read_table(spark, root, "t"), "id") == [("1",)]


def test_changes_are_read_and_folded(spark, tmp_path):
    root, day = str(tmp_path), dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

    def load(n, *data):
        tables.add_changes(frame(spark, *data), root, "p", F.lit(day + dt.timedelta(days=n)))

    def read():
        return rows(tables.read_keyed(spark, root, "p", ["id"], keep=["seen"]))

    assert tables.read_keyed(spark, root, "p", ["id"]) is None
    load(0, ("1", 1, "a"), ("2", 2, "a"))
    load(1, ("2", 20, "b"), ("3", 30, "b"))
    want = [("1", 1, "a"), ("2", 20, "a"), ("3", 30, "b")]
    assert read() == want
    load(1, ("2", 20, "b"), ("3", 30, "b"))  # delivered again
    assert read() == want
    tables.fold(spark, root, "p", ["id"], 4, keep=["seen"])
    assert read() == want
    load(2, ("1", None, "c"))
    assert read() == [("1", None, "a"), *want[1:]]
    with pytest.raises(ValueError):
        tables.fold(spark, root, "p", ["id"], 8, keep=["seen"])
    for _ in range(2):
        tables.fold(spark, root, "p", ["id"], 4, keep=["seen"])
        assert read() == [("1", None, "a"), *want[1:]]


def test_publish(spark, tmp_path):
    df = frame(spark, ("1", 1, "a"))
    tables.publish(df, "a_view", "view")
    assert rows(spark.table("a_view")) == rows(df)
    assert rows(tables.publish(df, "a_table", "table", str(tmp_path))) == rows(df)
    assert tables.read_table_or_none(spark, str(tmp_path), "none") is None
    tables.append(df.withColumn("extra", F.lit(7)), str(tmp_path), "a_table")
    merged = tables.read_table(spark, str(tmp_path), "a_table", merge_schema=True)
    assert rows(merged, "id", "extra") == [("1", 7), ("1", None)]
    with pytest.raises(ValueError):
        tables.publish(df, "x", "table")


# -- snapshots ---------------------------------------------------------------------------


def make_snapshots(spark, data):
    schema = "photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint"
    return spark.createDataFrame(data, schema)


def expected_deltas(data):
    out, last = [], {}
    for photo, when, *totals in sorted(data, key=lambda r: (r[0], r[1])):
        totals = [t or 0 for t in totals]
        before = last.get(photo, (0, 0, 0))
        out.append((photo, when, *totals, *[a - b for a, b in zip(totals, before)]))
        last[photo] = totals
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def snapshot_rows():
    rng = random.Random(3)
    times = rng.sample(range(60 * 24 * 30), 400)
    # photo "hot" has half of all snapshots
    return [("hot" if i % 2 else str(i % 7), T0 + dt.timedelta(minutes=m),
             rng.randrange(9), rng.choice([None, 4, 2]), i) for i, m in enumerate(times)]


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_deltas_brute_force(spark, snapshot_rows, unit):
    got = snapshots.stat_deltas(make_snapshots(spark, snapshot_rows), unit)
    assert rows(got) == expected_deltas(snapshot_rows)


def test_incremental_deltas(spark, snapshot_rows):
    cut = T0 + dt.timedelta(days=12)
    df = make_snapshots(spark, snapshot_rows)
    old, new = df.where(F.col("recorded_at") < cut), df.where(F.col("recorded_at") >= cut)
    got = snapshots.new_stat_deltas(new, old)
    assert rows(got) == [r for r in expected_deltas(snapshot_rows) if r[1] >= cut]


def test_single_and_decreasing(spark):
    df = make_snapshots(spark, [("a", T0, 3, 4, 5), ("b", T0, 9, 9, 9),
                                ("b", T0 + dt.timedelta(days=3), 1, None, 9)])
    got = [r[5:] for r in rows(snapshots.stat_deltas(df))]
    assert got == [(3, 4, 5), (9, 9, 9), (-8, -9, 0)]
