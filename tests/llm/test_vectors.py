import numpy as np
import pytest
from pyspark.sql import functions as F

from shutterlake.llm import ann, components, embed_dedup
from tests.llm.support import components as brute_components

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep string, vector int, id int, size int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2, 3) for i, v in rows], SCHEMA)


def sample(n=300, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 16))
    for i in range(n // 3, n // 2):  # near copies of earlier rows
        base[i] = base[i % 7] + rng.normal(scale=0.12, size=16)
    for i in range(n // 2, n // 2 + 40):  # one group of equal vectors
        base[i] = base[0]
    return [(int(i * 5), [float(x) for x in v]) for i, v in enumerate(base.astype(np.float32))]


ODD = [
    (9001, None),
    (9002, []),
    (9003, [0.0] * 16),
    (9004, [float("nan")] + [1.0] * 15),
    (9005, [float("inf")] + [1.0] * 15),
    (9006, [None] + [1.0] * 15),
    (None, [1.0] * 16),
    (9007, [1.0] * 8),
]


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    links = spark.createDataFrame([*pairs, (None, 3), (3, None)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)}
    assert components.connected_components(links.limit(0)).count() == 0


def test_embedding_dedup_equals_brute_force(spark):
    rows = sample()
    found = {r["vec_id"]: r for r in embed_dedup.near_duplicates(frame(spark, rows + ODD)).collect()}
    x = np.array([v for _, v in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    roots = brute_components(len(rows), zip(*np.nonzero(close), strict=True))
    for i, (name, _) in enumerate(rows):
        assert found[name]["n_links"] == close[i].sum()
        assert found[name]["component_id"] == rows[roots[i]][0]
        assert found[name]["kept"] == (roots[i] == i)
    for name, _ in ODD:
        assert found[name]["n_links"] == 0
        assert found[name]["component_id"] == name
        assert found[name]["kept"] == (name is not None)


def test_embedding_dedup_splits_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CHUNK", 20)
    monkeypatch.setattr(embed_dedup, "BLOCK", 64)
    test_embedding_dedup_equals_brute_force(spark)


def test_links_are_found_whatever_the_number_of_classes(spark):
    """Pairs at the threshold among many more vectors than a window holds."""
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(rng.normal(size=(2000, 64)))
    side = rng.normal(size=(400, 64))
    side = unit(side - (side * base[:400]).sum(axis=1, keepdims=True) * base[:400])
    x = np.concatenate([base, 0.91 * base[:400] + np.sqrt(1 - 0.91**2) * side])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    # a window of 2 meets as few of these rows as one of 1,024 of 1.2 million
    found = embed_dedup.near_duplicates(frame(spark, rows), window=2).collect()
    assert sum(r["n_links"] == 1 for r in found) >= 798


def test_passes_keep_the_miss_below_its_bound():
    same = 1 - np.arccos(0.9) / np.pi
    for n in (1, 64, 10_000, 100_000, 600_000, 10_000_000):
        bits = max(0, int(np.ceil(np.log2(n / 1024))))
        assert (1 - same**bits) ** embed_dedup.passes_for(n, 0.9, 1024, 1e-3) <= 1e-3


def test_repeated_vectors_and_empty_table(spark):
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (1, [2.0, 0.0]), (8, [0.0, 1.0])]
    found = sorted(map(tuple, embed_dedup.near_duplicates(frame(spark, rows)).collect()))
    assert found == [(1, 2, 1, True), (3, 2, 1, False), (3, 2, 1, False), (8, 0, 8, True)]
    assert embed_dedup.near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert ann.nearest(frame(spark, rows).limit(0), F.lit(True)).count() == 0


def test_hilbert_order_is_a_path_of_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    index = ann.hilbert_index(grid, 3)
    assert sorted(index) == list(range(512))
    steps = np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def recall(found, rows, window):
    """Share of the exact nearest ten that were found; scores and order are checked."""
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    hits = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        own = sorted((r for r in found if r["query_id"] == ids[i]), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        distance = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        for r in own:
            assert r["score"] == pytest.approx(distance[ids == r["vec_id"]][0], abs=1e-12)
        assert [r["score"] for r in own] == sorted(r["score"] for r in own)
        distance[i] = np.inf
        best = ids[np.lexsort((ids, distance))[:10]]
        if window is None:
            assert [r["vec_id"] for r in own] == best.tolist()
        hits += len(set(best) & {r["vec_id"] for r in own})
        total += 10
    return hits / total


def asked():
    return F.col("vec_id") % 100 == 0


def test_small_tables_are_compared_in_full(spark, monkeypatch):
    rows = sample()
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "QUERIES", 2)
    found = ann.nearest(frame(spark, rows + ODD[:6] + rows[:3]), asked()).collect()
    assert recall(found, rows, None) == 1


@pytest.mark.parametrize("kind", ["plain", "far", "tight"])
def test_windows_smaller_than_the_table(spark, monkeypatch, kind):
    """Twelve curves and 24 rows of each: a tenth of the table, where one row is very long or a
    third of all rows lie very close together."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 12))
    x = centres[rng.integers(0, 60, 3000)] + rng.normal(scale=0.4, size=(3000, 12))
    if kind == "far":
        x[7] *= 1e6
    if kind == "tight":
        x[::3] = x[0] + rng.normal(scale=1e-3, size=(1000, 12))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    monkeypatch.setattr(ann, "CELL", 256)
    found = ann.nearest(frame(spark, rows), asked(), window=12, curves=12).collect()
    assert recall(found, rows, 12) >= 0.9
    requests = ann._requests(
        ann.vectors.classes(frame(spark, rows).select("vec_id", "embedding").toDF("id", "vector"), "c",
                            F.max(F.col("id") % 100 == 0).alias("asked")), 12, 3000, 12, 12, 8, 7, 4096, 5)
    compared = sum(len(r["ids"]) // 8 for r in requests.collect())
    assert compared <= 30 * 12 * 25  # never more than the windows hold


def test_every_row_of_a_window_is_met(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 16)
    monkeypatch.setattr(ann, "RANGE", 40)
    rows = [(i, [float(i), 1.0]) for i in range(300)]
    groups = ann.vectors.classes(frame(spark, rows).select("vec_id", "embedding").toDF("id", "vector"), "c",
                                 F.max(F.col("id") % 10 == 0).alias("asked"))
    places = ann._places(groups, 2, 3, 2, 7, 300, 1)
    for row in ann._windows(places, 300, 9).collect():
        assert 10 <= len(set(np.frombuffer(row["ids"], np.int64))) == len(row["ids"]) // 8 <= 19
    ranges = places.groupBy("part").count().collect()
    assert len(ranges) == 3 * 8 and max(r["count"] for r in ranges) < 80
    assert places.groupBy("part", "row").count().where("count > 1").isEmpty()


def test_ids_that_repeat_with_other_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [-1.0, 0.0])]
    found = sorted(map(tuple, embed_dedup.near_duplicates(frame(spark, rows)).collect()))
    assert found == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]
    near = ann.nearest(frame(spark, rows), F.col("vec_id") == 1, k=1).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in near) == [(1, 2), (1, 3)]


@pytest.mark.parametrize("scale", [1e-200, 1e200])
def test_very_large_and_very_small_components(spark, scale):
    rows = [(1, [scale, 0.0]), (2, [scale, 0.01 * scale]), (3, [0.0, scale])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted(map(tuple, embed_dedup.near_duplicates(df).collect()))
    assert found == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    near = ann.nearest(df, F.col("vec_id") == 1).collect()
    assert [(r["vec_id"], r["score"]) for r in near] == [(2, 0.01 * scale), (3, pytest.approx(2**0.5 * scale))]


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 1.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (200, None)]
    found = ann.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in found] == [(0, 1, 1), (0, 2, 2)]
