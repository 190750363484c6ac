"""Nearest centroids by the tree against all comparisons."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.operators import centroid_tree
from vectable.operators.centroid_tree import build_tree, nearest_in_tree

CENTS, ROWS = "label int, mean array<double>", "id long, v array<double>"


def brute(x, c):
    d = ((x[:, None, :] - c[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@pytest.mark.parametrize("k,d,leaf", [(1, 3, 4), (7, 5, 2), (300, 8, 16), (300, 8, 1000)])
def test_tree_as_brute_force(spark, monkeypatch, k, d, leaf):
    monkeypatch.setattr(centroid_tree, "LEAF", leaf)
    r = np.random.default_rng(k + leaf)
    c = np.round(r.normal(size=(k, d)), 1)
    if k > 20:
        c[5], c[250] = c[11], c[11]  # ties
    x = np.concatenate([np.round(r.normal(size=(150, d)), 1), c[: min(k, 20)]])
    cents = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], CENTS).repartition(3)
    tree = build_tree(cents)
    got = {g["id"]: g for g in nearest_in_tree(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], ROWS), tree, "v").collect()}
    own, dist = brute(x, c)
    for i in range(len(x)):
        assert got[i]["distance"] == pytest.approx(dist[i], abs=1e-9)
        # Equal distances but for rounding: any of them; equal centroids: the smallest label.
        assert got[i]["prediction"] == own[i] or abs(((x[i] - c[got[i]["prediction"]]) ** 2).sum() - dist[i]) < 1e-9
    if k > 20:
        assert got[150 + 5]["prediction"] == 5 and got[150 + 11]["prediction"] == 5
    assert len(tree.far) >= k / leaf


def test_ten_thousand_classes_take_few_comparisons(spark):
    r = np.random.default_rng(9)
    centre = r.normal(size=(100, 6)) * 50
    c = centre[np.arange(10_000) % 100] + r.normal(size=(10_000, 6))
    x = c[r.integers(0, 10_000, 400)] + r.normal(size=(400, 6)) * 0.1
    cents = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], CENTS)
    tree = build_tree(cents)
    out = nearest_in_tree(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], ROWS), tree, "v").collect()
    own, _ = brute(x, c)
    assert {g["id"]: g["prediction"] for g in out} == dict(enumerate(own.tolist()))
    assert np.mean([g["n_compared"] for g in out]) < 2500  # of 10,000
    assert tree.n == 10_000 and tree.pivots.shape == (100, 6)


def test_unusable_rows_and_centroids(spark, monkeypatch):
    monkeypatch.setattr(centroid_tree, "CACHE_BYTES", 10)  # one leaf at a time
    monkeypatch.setattr(centroid_tree, "LEAF", 1)
    cents = spark.createDataFrame([("b", [0.0, 0.0]), ("a", [0.0, 0.0]), ("c", [5.0, 5.0]), ("d", None), (None, [1.0, 1.0]), ("e", [float("nan"), 1.0])], "label string, mean array<double>")
    tree = build_tree(cents)
    rows = [(1, [0.1, 0.0]), (2, [4.0, 4.0]), (3, None), (4, [1.0]), (5, [None, 1.0]), (6, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, ROWS).withColumn("prediction", F.lit("mine"))
    got = {g["id"]: g["prediction"] for g in nearest_in_tree(df, tree, "v").collect()}
    assert got == {1: "a", 2: "c", 3: None, 4: None, 5: None, 6: None}
    assert nearest_in_tree(df.limit(0), tree, "v").count() == 0
    with pytest.raises(ValueError, match="no centroids"):
        build_tree(cents.limit(0))
    with pytest.raises(ValueError, match="unequal"):
        build_tree(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], CENTS))
