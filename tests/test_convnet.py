"""The convolutional classifier against slow loops, differences and itself."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.operators import convnet
from vectable.operators.convnet import Network
from vectable.operators.quality import EmptyInputError

ROWS = "id long, label int, v array<double>"


def slow_forward(net, weights, image):
    """One image, loop by loop."""
    w = net.layers(weights)
    a = image.reshape(net.height, net.width, net.channels)
    for i in (0, 2):
        if net.same:
            a = np.pad(a, ((1, 1), (1, 1), (0, 0)))
        h, wd, c = a.shape
        f = w[i].shape[1]
        z = np.zeros((h - 2, wd - 2, f))
        for y in range(h - 2):
            for x in range(wd - 2):
                for o in range(f):
                    s = w[i + 1][o]
                    for dy in range(3):
                        for dx in range(3):
                            for k in range(c):
                                s += a[y + dy, x + dx, k] * w[i][(dy * 3 + dx) * c + k, o]
                    z[y, x, o] = max(s, 0)
        a = np.array([[[max(z[2 * y + p, 2 * x + q, o] for p in (0, 1) for q in (0, 1)) for o in range(f)] for x in range(z.shape[1] // 2)] for y in range(z.shape[0] // 2)])
    hidden = np.maximum(a.ravel() @ w[4] + w[5], 0)
    e = np.exp(hidden @ w[6] + w[7])
    return e / e.sum(), hidden


SMALL = [Network(10, 11, 2, 3, (2, 3), 4), Network(8, 8, 1, 4, (3, 2), 5, same=True), Network(5, 9, 3, 2, (2, 2), 3, same=True)]


@pytest.mark.parametrize("net", SMALL)
def test_forward_as_loops(net):
    r = np.random.default_rng(1)
    weights = net.start(3) + r.normal(size=net.size) * 0.1
    x = r.normal(size=(4, net.inputs))
    p, hidden, _ = net.forward(weights, x)
    for i in range(4):
        q, h = slow_forward(net, weights, x[i])
        assert np.allclose(p[i], q, atol=1e-12) and np.allclose(hidden[i], h, atol=1e-12)


@pytest.mark.parametrize("net", SMALL)
def test_gradient_as_differences(net):
    r = np.random.default_rng(2)
    weights = net.start(4) + r.normal(size=net.size) * 0.05
    x, y = r.normal(size=(6, net.inputs)), r.integers(0, net.classes, 6)
    g, loss, right = net.gradient(weights, x, y)
    p, _, _ = net.forward(weights, x)
    assert loss == pytest.approx(-np.log(p[np.arange(6), y]).sum()) and right == (p.argmax(1) == y).sum()

    def at(w):
        q, _, _ = net.forward(w, x)
        return -np.log(q[np.arange(6), y]).sum()

    for i in range(net.size):
        step = np.zeros(net.size)
        step[i] = 1e-6
        assert (at(weights + step) - at(weights - step)) / 2e-6 == pytest.approx(g[i], abs=1e-6)


def test_shapes_of_the_reference_size():
    net = Network(256, 256, 3, 4)
    assert net.shapes() == [(27, 32), (32,), (288, 64), (64,), (62 * 62 * 64, 64), (64,), (64, 4), (4,)]
    assert net.chunk() >= 1
    with pytest.raises(ValueError, match="too small"):
        Network(8, 8, 1, 3).shapes()


def pictures(n=160, seed=5):
    """Bars that lie or stand, with noise: what convolutions tell apart."""
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = r.normal(size=(8, 8)) * 0.3
        at = r.integers(1, 7)
        if i % 2:
            x[at, :] += 2
        else:
            x[:, at] += 2
        rows.append((i, i % 2, x.ravel().tolist()))
    return rows


NET = Network(8, 8, 1, 2, (4, 4), 8, same=True)


def local_fit(rows, table_steps, epochs, seed):
    """The same optimiser on one machine."""
    state = convnet.new_fit(NET, 7)
    w, m, v, t = state.weights, state.first, state.second, 0
    for epoch in range(1, epochs + 1):
        for step in np.random.default_rng([seed, epoch]).permutation(sorted(table_steps)):
            ids = table_steps[step]
            x, y = np.array([rows[i][2] for i in ids]), np.array([rows[i][1] for i in ids])
            g, _, _ = NET.gradient(w, x, y)
            g, t = g / len(ids), t + 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - 1e-2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
    return w


def test_fit_is_the_same_for_any_partitions_and_learns(spark):
    rows = pictures()
    # Rows that cannot be learned from: no class, no vector, a short one, one with a NaN.
    bad = [(900, None, rows[0][2]), (901, 5, rows[0][2]), (902, -1, rows[0][2]), (903, 0, None), (904, 1, [1.0]), (905, 1, [float("nan")] * 64)]
    train = spark.createDataFrame(rows[:120] + bad, ROWS)
    test = spark.createDataFrame(rows[120:], ROWS)
    kw = {"epochs": 6, "batch_size": 30, "seed": 11, "rate": 1e-2}
    fits = [convnet.fit(train.repartition(k), "id", "label", "v", convnet.new_fit(NET, 7), validation=test, **kw) for k in (1, 5)]
    assert np.allclose(fits[0].weights, fits[1].weights, atol=1e-9)
    assert fits[0].steps == 24 and [h[0] for h in fits[0].history] == [1, 2, 3, 4, 5, 6]
    assert fits[0].history[-1][3] > 0.9 and fits[0].history[-1][2] < fits[0].history[0][2]
    # The same batches on one machine.
    from vectable.operators import batching

    good = convnet.usable_rows(train, NET, "label", "v")
    steps: dict = {}
    for r in batching.mini_batches(good, "id", 11, 30, batch_col="step").collect():
        steps.setdefault(r["step"], []).append(r["id"])
    assert sorted(map(len, steps.values())) == [30] * 4
    assert np.allclose(local_fit(rows, steps, 6, 11), fits[0].weights, atol=1e-9)
    # History: validation accuracy and loss are those of the predictions.
    p = convnet.predict(fits[0], test, "v")
    own = F.element_at("probability", F.col("label") + 1)
    a, loss = p.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")), F.avg(-F.log(own))).first()
    assert fits[0].history[-1][3] == pytest.approx(a) and fits[0].history[-1][4] == pytest.approx(loss)


def test_resumed_fit_saved_and_loaded_is_the_straight_one(spark, tmp_path):
    train = spark.createDataFrame(pictures(60), ROWS)
    kw = {"batch_size": 25, "seed": 3, "rate": 1e-2}
    straight = convnet.fit(train, "id", "label", "v", convnet.new_fit(NET, 7), epochs=3, **kw)
    half = convnet.fit(train, "id", "label", "v", convnet.new_fit(NET, 7), epochs=1, **kw)
    convnet.save_fit(spark, half, str(tmp_path / "m"))
    back = convnet.load_fit(spark, str(tmp_path / "m"))
    assert back.network == NET and back.steps == 3
    whole = convnet.fit(train, "id", "label", "v", back, epochs=3, **kw)
    assert np.allclose(whole.weights, straight.weights, atol=1e-10)
    assert convnet.history_frame(spark, whole).count() == 3
    assert [h[:1] for h in whole.history] == [h[:1] for h in straight.history]
    assert convnet.fit(train, "id", "label", "v", whole, epochs=3, **kw).steps == whole.steps  # nothing left to do


def test_predict_keeps_rows_without_a_vector(spark):
    state = convnet.new_fit(NET, 7)
    rows = [(1, 0, [0.5] * 64), (2, 0, None), (3, 0, [1.0]), (4, 0, [None] * 64), (5, 0, [float("inf")] * 64)]
    df = spark.createDataFrame(rows, ROWS).withColumn("probability", F.lit("mine"))
    out = {r["id"]: r for r in convnet.predict(state, df, "v", hidden_col="h").collect()}
    assert out[1]["prediction"] in (0, 1) and sum(out[1]["probability"]) == pytest.approx(1) and len(out[1]["h"]) == 8
    assert all(out[i]["prediction"] is None and out[i]["probability"] is None and out[i]["h"] is None for i in (2, 3, 4, 5))
    assert convnet.predict(state, df.limit(0), "v").count() == 0


def test_no_rows_and_too_many_steps(spark, monkeypatch):
    with pytest.raises(EmptyInputError):
        convnet.fit(spark.createDataFrame([], ROWS), "id", "label", "v", convnet.new_fit(NET))
    monkeypatch.setattr(convnet, "MAX_STEPS", 2)
    with pytest.raises(ValueError, match="larger batches"):
        convnet.fit(spark.createDataFrame(pictures(10), ROWS), "id", "label", "v", convnet.new_fit(NET), batch_size=2)


def test_a_step_reads_its_folder_only(spark):
    table = convnet.dealt(spark.createDataFrame(pictures(40), ROWS), NET, "id", "label", "v", 10, 1)
    plan = table.where(F.col("step") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(step" in plan and "(step" in plan
    assert table.groupBy("step").count().where("count <> 10").count() == 0
