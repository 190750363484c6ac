"""The neighbour-preserving map: graph against brute force, preservation
against principal components, the same result for a seed."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.operators import model, neighbour_map as nm
from vectable.sources.tables import table

ROWS = "id long, v array<double>, label string"


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, v.tolist(), f"l{i % 3}") for i, v in enumerate(x)], ROWS).repartition(parts)


def true_neighbours(x, k):
    d = ((x[:, None, :] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :k]


def found(graph):
    ids = {r["n"]: r["c0"] for r in graph.points.collect()}
    return {ids[r["n"]]: [(e["d"], ids[e["n"]]) for e in r["near"]] for r in graph.edges.collect()}


def kept(x, y, k=10):
    """Share of the true neighbours that are neighbours on the map."""
    return np.mean([len(set(a) & set(b)) / k for a, b in zip(true_neighbours(x, k), true_neighbours(y, k), strict=True)])


def points(df, n):
    got = {r["id"]: (r["x"], r["y"]) for r in df.collect()}
    return np.array([got[i] for i in range(n)])


def test_one_leaf_is_brute_force(spark):
    x = np.random.default_rng(1).normal(size=(120, 5))
    got = found(nm.neighbour_graph(frame(spark, x), "v", ["id", "label"], k=7))
    for i, want in enumerate(true_neighbours(x, 7)):
        assert [n for _, n in got[i]] == want.tolist()
        assert [d for d, _ in got[i]] == pytest.approx(((x[want] - x[i]) ** 2).sum(1))


def test_trees_find_most_neighbours(spark, monkeypatch):
    monkeypatch.setattr(nm, "LEAF", 64)
    r = np.random.default_rng(2)
    x = r.normal(size=(40, 8))[r.integers(0, 40, 1500)] * 3 + r.normal(size=(1500, 8))
    got = found(nm.neighbour_graph(frame(spark, x), "v", ["id"], k=10))
    want = true_neighbours(x, 10)
    assert np.mean([len({n for _, n in got[i]} & set(want[i].tolist())) / 10 for i in range(1500)]) > 0.8
    assert all(len(e) == 10 and i not in {n for _, n in e} and len({n for _, n in e}) == 10 for i, e in got.items())


def test_a_third_the_same_vector(spark, monkeypatch):
    monkeypatch.setattr(nm, "LEAF", 32)
    x = np.random.default_rng(3).normal(size=(300, 4))
    x[::3] = x[0]
    graph = nm.neighbour_graph(frame(spark, x), "v", ["id"], k=5)
    got = found(graph)
    assert len(got) == 300 and all(d == 0 for i in range(0, 300, 3) for d, _ in got[i])
    pointed = np.bincount([n for e in got.values() for _, n in e], minlength=300)
    assert pointed.max() <= 6 * 32
    y = points(nm.neighbour_map(frame(spark, x), "v", ["id"], "label", k=5, rounds=2), 300)
    assert np.isfinite(y).all()


def test_keeps_more_neighbours_than_principal_components(spark):
    r = np.random.default_rng(4)
    t = r.uniform(0, 4 * np.pi, 600)  # a rolled-up sheet
    x = np.stack([t * np.cos(t), t * np.sin(t), r.uniform(0, 20, 600)], axis=1)
    df = frame(spark, x)
    flat = points(model.project_2d(df, "v", ["id"], "label"), 600)
    own = points(nm.neighbour_map(df, "v", ["id"], "label"), 600)
    assert kept(x, own) > 1.4 * kept(x, flat)
    graph = nm.neighbour_graph(df, "v", ["id"])
    assert nm.closeness(graph, nm.layout(graph)) < nm.closeness(graph, nm.start(graph, 42)) < 1


def test_all_embeddings_and_any_partitions(spark):
    e = table(spark, "/root/testdata/sf0.01", "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")
    rows = sorted(e.collect(), key=lambda r: r["id"])
    x, ids = np.array([r["v"] for r in rows], float), [r["id"] for r in rows]

    def on_map(df):
        got = {r["id"]: (r["x"], r["y"]) for r in df.collect()}
        return np.array([got[i] for i in ids])

    a = on_map(nm.neighbour_map(e, "v", ["id"], "label"))
    b = on_map(nm.neighbour_map(e.repartition(7), "v", ["id"], "label"))
    assert np.abs(a - b).max() < 1e-3
    assert kept(x, a) > 2 * kept(x, on_map(model.project_2d(e, "v", ["id"], "label")))


def test_blocks_of_many_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(nm, "BLOCK", 50)
    monkeypatch.setattr(nm, "LEAF", 40)
    r = np.random.default_rng(5)
    x = np.repeat(r.normal(size=(10, 6)) * 5, 23, axis=0) + r.normal(size=(230, 6))
    df = frame(spark, x)
    assert kept(x, points(nm.neighbour_map(df, "v", ["id"], "label", k=8), 230)) > kept(x, points(model.project_2d(df, "v", ["id"], "label"), 230))


def test_unusable_rows_few_rows_and_none(spark):
    bad = [(1, [1.0, 2.0], "a"), (2, None, "b"), (3, [1.0], "c"), (4, [None, 1.0], None), (5, [float("inf"), 0.0], "d"), (6, [3.0, 2.0], "a"), (6, [3.0, 2.0], "a"), (None, [0.0, 1.0], "e")]
    df = spark.createDataFrame(bad, ROWS).withColumn("n", F.lit("mine"))
    got = nm.neighbour_map(df, "v", ["id", "n"], "label", rounds=1).collect()
    assert sorted((r["id"] or 0, r["x"] is None) for r in got) == [(0, False), (1, False), (2, True), (3, True), (4, True), (5, True), (6, False), (6, False)]
    one = nm.neighbour_map(df.where("id = 1"), "v", ["id"], "label").collect()
    assert [(r["x"], r["y"]) for r in one] == [(0.0, 0.0)]
    assert nm.neighbour_map(df.limit(0), "v", ["id"], "label").count() == 0
    assert [r["x"] for r in nm.neighbour_map(df.where("id = 2"), "v", ["id"], "label").collect()] == [None]
    thin = spark.createDataFrame([(i, [float(i)], "a") for i in range(20)], ROWS)
    assert nm.neighbour_map(thin, "v", ["id"], "label", k=3, rounds=1).where("x is not null").count() == 20


def test_tables_of_the_graph_are_spread_over_the_cores(spark, monkeypatch):
    """a small table is much work; ranges of few rows number the same points."""
    r = np.random.default_rng(8)
    rows = [(i, i % 3, [float(x) for x in r.normal(size=4)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>").coalesce(1)
    many = []
    plain = nm.ranked
    monkeypatch.setattr(nm, "ranked", lambda *a: many.append(plain(*a)) or many[-1])

    def graph():
        g = nm.neighbour_graph(df, "v", ["id", "label"], k=5)
        return g, {x["n"]: x["c0"] for x in g.points.collect()}

    whole, points = graph()
    assert len(whole.points.inputFiles()) >= min(spark.sparkContext.defaultParallelism, 100)
    alone = [len(x.starts) for x in many]
    many.clear()
    monkeypatch.setattr(nm, "SORTED", 100)
    assert graph()[1] == points
    assert alone == [1, 1] and min(len(x.starts) for x in many) > 1
