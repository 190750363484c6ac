"""Metric properties on random predictions."""

from __future__ import annotations

import numpy as np
import pytest

from vectable.operators import labels, metrics


@pytest.fixture(scope="module")
def preds(spark):
    rng = np.random.default_rng(3)
    t = rng.integers(0, 5, 400)
    p = np.where((rng.random(400) < 0.6) & (t < 4), t, rng.integers(0, 4, 400))  # class 4 never predicted
    return spark.createDataFrame([(int(a), int(b)) for a, b in zip(t, p)], "t int, p int"), t, p


def test_matrix_sums(spark, preds):
    df, t, p = preds
    long = metrics.confusion_long(df, "t", "p").collect()
    assert len(long) == 25
    assert sum(r["n"] for r in long) == len(t)
    rep = {r["cls"]: r for r in metrics.class_report(df, "t", "p").collect()}
    for c in range(5):
        assert sum(r["n"] for r in long if r["true"] == c) == rep[c]["support"] == int((t == c).sum())
    assert rep[4]["precision"] == 0.0


def test_weighted_recall_is_accuracy(spark, preds):
    df, t, p = preds
    rep = metrics.class_report(df, "t", "p")
    s = {r["metric"]: r for r in metrics.report_summary(rep, df, "t", "p").collect()}
    assert s["weighted avg"]["recall"] == pytest.approx(s["accuracy"]["f1"])
    assert s["accuracy"]["f1"] == pytest.approx(float((t == p).mean()))


def test_unknown_classes_keep_their_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), ("b", "zz"), (None, "a")], "t string, p string")
    classes = spark.createDataFrame([("a",), ("b",)], "c string")
    got = {(r["true"], r["pred"]): r["n"] for r in metrics.confusion_long(df, "t", "p", classes).collect()}
    assert got == {("a", "a"): 1, ("a", "b"): 0, ("b", "a"): 0, ("b", "b"): 0, ("a", None): 1, ("b", "zz"): 1, (None, "a"): 1}
    assert sum(got.values()) == df.count()


def test_cross_entropy(spark):
    df = spark.createDataFrame([([0.7, 0.2, 0.1], 0), ([0.0, 1.0, 0.0], 0)], "p array<double>, i int")
    ce = metrics.cross_entropy(df, "p", "i").first()["cross_entropy"]
    assert ce == pytest.approx((-np.log(0.7) - np.log(1e-7)) / 2)


def test_encode_decode_identity_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "label string")
    dim = labels.label_dictionary(df.where("label <> 'c'"))
    assert sorted(tuple(r) for r in dim.collect()) == [("a", 0), ("b", 1)]
    enc = labels.encode_labels(df, dim)
    got = {r["label"]: r["label_index"] for r in enc.collect()}
    assert got == {"a": 0, "b": 1, "c": -1, None: -1}
    known = enc.where("label_index >= 0")
    dec = labels.decode_labels(known, dim, {"label_index": "name"})
    assert all(r["name"] == r["label"] for r in dec.collect())
    with pytest.raises(Exception, match="unknown label index"):
        labels.decode_labels(enc, dim, {"label_index": "name"}).collect()
