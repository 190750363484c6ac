"""Class centroids and nearest-centroid scoring against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from vectable.operators import vectors


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    rows = [(i, int(i % 7), [float(x) for x in rng.normal(i % 7, 1.0, 6)]) for i in range(140)]
    return spark.createDataFrame(rows, "id long, label int, v array<double>"), rows


def _brute(rows):
    labels = sorted({r[1] for r in rows})
    cents = {c: np.mean([r[2] for r in rows if r[1] == c], axis=0) for c in labels}
    out = {}
    for i, _, v in rows:
        d = [(float(np.sum((np.array(v) - cents[c]) ** 2)), c) for c in labels]
        out[i] = min(d)[1]
    return cents, out


def test_class_means(spark, data):
    df, rows = data
    cents, _ = _brute(rows)
    got = {r["label"]: np.array(r["mean"]) for r in vectors.class_means(df, "label", "v").collect()}
    for c in cents:
        assert np.allclose(got[c], cents[c])


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
@pytest.mark.parametrize("budget", [vectors.BLOCK_BYTES, 200])
def test_nearest_centroid_single_and_chunked(spark, data, budget, engine):
    df, rows = data
    cents_exp, exp = _brute(rows)
    cents = vectors.class_means(df, "label", "v")
    out = vectors.nearest_centroid(df, cents, "v", block_bytes=budget, with_distances=True, engine=engine)
    got = {r["id"]: r["prediction"] for r in out.collect()}
    assert got == exp
    probs = vectors.class_probabilities(out).collect()
    for r in probs:
        assert abs(sum(r["probability"]) - 1) < 1e-9
        assert r["classes"] == sorted(cents_exp)
        v = np.array(next(x[2] for x in rows if x[0] == r["id"]))
        assert np.allclose(r["distances"], [np.sum((v - cents_exp[c]) ** 2) for c in r["classes"]])


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
def test_nearest_centroid_null_and_short_vectors(spark, data, engine):
    df, _ = data
    cents = vectors.class_means(df, "label", "v")
    bad = [None, [1.0, 2.0], [float("nan")] + [0.0] * 5, [None] + [0.0] * 5, [float("inf")] + [0.0] * 5]
    odd = spark.createDataFrame([(1000 + i, 0, v) for i, v in enumerate(bad)], "id long, label int, v array<double>")
    out = vectors.nearest_centroid(odd, cents, "v", engine=engine).collect()
    assert [r["prediction"] for r in out] == [None] * len(bad)


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
@pytest.mark.parametrize("block", [vectors.BLOCK_BYTES, 1])
def test_nearest_centroid_keeps_rows_of_any_key(spark, engine, block):
    """The number of blocks changes nothing, nor do keys that repeat or are NULL."""
    df = spark.createDataFrame([(1, 0, [0.0, 0.0]), (1, 1, [1.0, 1.0]), (None, 0, [0.1, 0.0])], "id long, label int, v array<double>")
    cents = spark.createDataFrame([(1, [1.0, 1.0]), (0, [0.0, 0.0]), (2, [0.0, 0.0])], "label int, mean array<double>")
    out = vectors.nearest_centroid(df, cents, "v", engine=engine, block_bytes=block, with_distances=True).collect()
    assert sorted((r["id"] or -1, r["label"], r["prediction"]) for r in out) == [(-1, 0, 0), (1, 0, 0), (1, 1, 1)]
    assert all(r["classes"] == [0, 1, 2] for r in out)


def test_blocks_of_centroids_share_a_worker(spark):
    """a Python worker a task, not one for each block of centroids."""
    rows = [(i, [float(i % 9), float(i % 4)]) for i in range(60)] + [(60, None), (61, [float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    points = [(c, [float(c), float(c % 3)]) for c in range(9)]
    cents = spark.createDataFrame(points, "label int, mean array<double>")
    out = vectors.nearest_centroid(df, cents, "v", dist_col="d", block_bytes=64)  # two in a block
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    for r in out.collect():
        if r["id"] >= 60:
            assert r["prediction"] is None and r["d"] is None
            continue
        want = [sum((a - b) ** 2 for a, b in zip(rows[r["id"]][1], c, strict=True)) for _, c in points]
        assert (r["prediction"], r["d"]) == (want.index(min(want)), min(want))


def test_class_means_skip_nan_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 3.0]), (0, [float("nan"), 1.0]), (0, [float("inf"), 1.0])], "label int, v array<double>")
    r = vectors.class_means(df, "label", "v").first()
    assert (r["mean"], r["n_rows"]) == ([1.0, 3.0], 1)


def test_uniform_dim(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>")
    with pytest.raises(ValueError, match="unequal"):
        vectors.check_uniform_dim(df, "v")


def test_class_means_skip_missing_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 3.0]), (0, None), (1, [2.0, 2.0])], "label int, v array<double>")
    got = {r["label"]: (r["mean"], r["n_rows"]) for r in vectors.class_means(df, "label", "v").collect()}
    assert got == {0: ([1.0, 3.0], 1), 1: ([2.0, 2.0], 1)}


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
def test_standardize_input_equals_prestandardized(spark, data, engine):
    from vectable.functions import arrays as A

    df, _ = data
    flat = spark.createDataFrame([(999, 0, [2.0] * 6)], "id long, label int, v array<double>")
    raw = df.unionByName(flat)
    z = raw.select("id", "label", A.standardize("v").alias("v"))
    cents = vectors.class_means(z, "label", "v")
    a = {r["id"]: r["prediction"] for r in vectors.nearest_centroid(z, cents, "v", engine=engine).collect()}
    b = {r["id"]: r["prediction"] for r in vectors.nearest_centroid(raw, cents, "v", engine=engine, standardize_input=True).collect()}
    assert a == b
    assert b[999] is None
