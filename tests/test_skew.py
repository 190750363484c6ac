"""A class holding a third of all rows: results stay whole and exact."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from vectable.operators import batching, labels, metrics, vectors


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    n = 3000
    # class 0 holds one third of the rows, the rest spread over 20 classes
    lab = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 21, n))
    pred = np.where(rng.random(n) < 0.7, lab, rng.integers(0, 21, n))
    vec = [[float(x) for x in rng.normal(int(c), 1.0, 4)] for c in lab]
    rows = [(i, int(a), int(b), v) for i, (a, b, v) in enumerate(zip(lab, pred, vec))]
    df = spark.createDataFrame(rows, "id long, label int, pred int, v array<double>").repartition(8)
    return df, rows


def test_report_under_skew(spark, skewed):
    df, rows = skewed
    rep = {r["cls"]: r for r in metrics.class_report(df, "label", "pred").collect()}
    support = Counter(r[1] for r in rows)
    predicted = Counter(r[2] for r in rows)
    tp = Counter(r[1] for r in rows if r[1] == r[2])
    assert rep[0]["support"] == support[0] == 1000
    for c in support:
        assert rep[c]["precision"] == pytest.approx(tp[c] / predicted[c] if predicted[c] else 0.0)
        assert rep[c]["recall"] == pytest.approx(tp[c] / support[c])


def test_top_n_and_means_under_skew(spark, skewed):
    df, rows = skewed
    top = batching.first_n_per_group(df, "label", ["id"], 3).collect()
    exp = {}
    for i, c, _, _ in sorted(rows):
        exp.setdefault(c, [])
        if len(exp[c]) < 3:
            exp[c].append(i)
    got = {}
    for r in top:
        got.setdefault(r["label"], []).append(r["id"])
    assert {c: sorted(v) for c, v in got.items()} == exp
    means = {r["label"]: r["mean"] for r in vectors.class_means(df, "label", "v").collect()}
    assert np.allclose(means[0], np.mean([r[3] for r in rows if r[1] == 0], axis=0))


def test_batches_and_dictionary_under_skew(spark, skewed):
    df, rows = skewed
    b = {r["id"]: r["row_idx"] for r in batching.mini_batches(df, "id", seed=9).collect()}
    order = sorted((r[0] for r in rows), key=lambda i: (hashlib.md5(f"{i}9".encode()).hexdigest(), i))
    assert b == {i: pos for pos, i in enumerate(order)}
    dim = labels.label_dictionary(df.select("label"))
    assert [r["label"] for r in dim.orderBy("label_index").collect()] == sorted(set(r[1] for r in rows))
