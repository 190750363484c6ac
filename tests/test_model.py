"""Spark ML classifier: fit, score, history, hidden features, persistence."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from vectable.functions import arrays as A
from vectable.operators import model


@pytest.fixture(scope="module")
def fitted(spark):
    e = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").select("vec_id", "label", A.standardize("embedding").alias("z"))
    m = model.fit_classifier(e, "z", "label", 10, hidden=16, max_iter=20, seed=1)
    return m, e


def test_predict_probabilities(spark, fitted):
    m, e = fitted
    out = model.predict(m, e, "z").collect()
    assert len(out) == e.count()
    for r in out:
        assert 0 <= r["prediction"] < 10
        assert abs(sum(r["probability"]) - 1) < 1e-9
        assert r["prediction"] == int(np.argmax(r["probability"]))


def test_null_vector_gives_null_prediction(spark, fitted):
    m, e = fitted
    one = e.limit(1).withColumn("z", F.lit(None).cast("array<double>"))
    assert model.predict(m, one, "z").first()["prediction"] is None


def test_hidden_features_reproduce_forward_pass(spark, fitted):
    """The hidden-layer weight layout is right if a numpy forward pass from it
    gives the model's own probabilities."""
    m, e = fitted
    mlp = m.stages[-1]
    d, h, k = mlp.getLayers()
    w = mlp.weights.toArray()
    off = d * h + h
    W2 = w[off : off + h * k].reshape(h, k).T
    b2 = w[off + h * k : off + h * k + k]
    feats = model.hidden_features(m, e, "z").orderBy("vec_id").limit(20).collect()
    probs = {r["vec_id"]: r["probability"] for r in model.predict(m, e, "z").collect()}
    for r in feats:
        z = W2 @ np.array(r["hidden"]) + b2
        p = np.exp(z - z.max())
        p /= p.sum()
        assert np.allclose(p, probs[r["vec_id"]], atol=1e-6)


def test_history_and_projection(spark, fitted):
    m, e = fitted
    hist = model.training_history(m)
    assert hist[-1][1] < hist[0][1]
    xy = model.project_2d(model.hidden_features(m, e, "z"), "hidden", ["vec_id"], "label")
    assert xy.count() == e.count()
    assert xy.columns == ["vec_id", "x", "y", "label"]


def test_save_load(spark, fitted, tmp_path):
    m, e = fitted
    model.save_model(m, str(tmp_path / "m"))
    m2 = model.load_model(str(tmp_path / "m"))
    a = {r["vec_id"]: r["prediction"] for r in model.predict(m, e, "z").collect()}
    b = {r["vec_id"]: r["prediction"] for r in model.predict(m2, e, "z").collect()}
    assert a == b


def test_unusable_vectors_never_end_fit_or_score(spark, fitted):
    m, e = fitted
    nan, inf = float("nan"), float("inf")
    bad = [(10_000 + i, 0, v) for i, v in enumerate([None, [1.0], [nan] * 64, [None] * 64, [inf] + [0.0] * 63])]
    both = e.unionByName(spark.createDataFrame(bad, "vec_id long, label int, z array<double>"))
    got = {r["vec_id"]: r["prediction"] for r in model.predict(m, both, "z").collect()}
    assert all(got[b[0]] is None for b in bad) and sum(p is not None for p in got.values()) == e.count()
    hidden = {r["vec_id"]: r["hidden"] for r in model.hidden_features(m, both, "z").collect()}
    assert all(hidden[b[0]] is None for b in bad)
    again = model.fit_classifier(both, "z", "label", 10, hidden=16, max_iter=2, seed=1)
    assert again.stages[-1].getLayers()[0] == 64


def test_projection_of_one_row_keeps_the_types(spark, fitted):
    m, e = fitted
    one = model.project_2d(model.hidden_features(m, e.limit(1), "z"), "hidden", ["vec_id"], "label")
    assert one.count() == 0 and one.dtypes == [("vec_id", "bigint"), ("x", "double"), ("y", "double"), ("label", "int")]
