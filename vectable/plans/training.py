"""Registered queries over the convolutional classifier: ``embeddings`` as 8 x 8
images of one channel. What SQL can compute is compared in full (the first
gradient of the last layer); the rest by facts that hold for any right fit,
counted over all rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.functions import arrays as A
from vectable.operators import convnet
from vectable.operators.common import materialize
from vectable.plans import mapping as M
from vectable.plans.catalog import _embeddings, _r, query
from vectable.plans.jobs import TRAIN_BELOW, _is_train
from vectable.session import scratch_path

EPOCHS, BATCHES, FILTERS, HIDDEN = 2, 4, (4, 8), 16


def _images(spark, sf) -> DataFrame:
    return _embeddings(spark, sf).select("vec_id", "label", A.standardize("embedding").alias("z"))


def _network(z: DataFrame) -> convnet.Network:
    classes = int(z.agg(F.max("label")).first()[0]) + 1
    return convnet.Network(8, 8, 1, classes, FILTERS, HIDDEN, same=True)


def _fitted(z: DataFrame, network: convnet.Network, epochs: int, state: convnet.Fit | None = None, **kw) -> convnet.Fit:
    return convnet.fit(z.where(_is_train()), "vec_id", "label", "z", state or convnet.new_fit(network, M.BATCH_SEED), epochs, seed=M.BATCH_SEED, **kw)


def _batch_size(z: DataFrame) -> int:
    return -(-z.where(_is_train()).count() // BATCHES)


@query("conv_first_gradient")
def conv_first_gradient(spark, sf):
    """K1: summed gradient of the last layer's biases, loss and right ones over
    all training rows, from weights whose last layer is 0: every class has the
    same probability."""
    z = _images(spark, sf)
    net = _network(z)
    weights = net.start(M.BATCH_SEED)
    weights[-(HIDDEN + 1) * net.classes :] = 0
    table = convnet.dealt(z.where(_is_train()), net, "vec_id", "label", "z", 1 << 40, M.BATCH_SEED)
    total = convnet.step_gradient(table, 0, net, weights, "label", "z")
    biases = total[-3 - net.classes : -3]
    rows = [(c, float(g), float(total[-3]), int(total[-2]), int(total[-1])) for c, g in enumerate(biases)]
    out = spark.createDataFrame(rows, "cls int, gradient double, loss double, n_right long, n_rows long")
    return out.select("cls", _r("gradient").alias("gradient"), _r("loss").alias("loss"), "n_right", "n_rows")


@query("conv_history")
def conv_history(spark, sf):
    """A fit that goes on epoch by epoch, the predictions of
    each epoch stored; its history has the accuracy and loss that the stored
    predictions give."""
    z = materialize(_images(spark, sf), "images")
    net, size = _network(z), _batch_size(z)
    table = convnet.dealt(z.where(_is_train()), net, "vec_id", "label", "z", size, M.BATCH_SEED)
    held_out, path, state = z.where(~_is_train()), scratch_path(spark, "epoch-predictions"), None
    for epoch in range(1, EPOCHS + 1):
        state = _fitted(z, net, epoch, state, table=table, validation=held_out)
        convnet.predict(state, held_out, "z").select("vec_id", "label", "prediction", "probability").write.parquet(f"{path}/epoch={epoch}")
    scored = spark.read.schema("vec_id long, label int, prediction int, probability array<double>, epoch int").parquet(path)
    own = F.element_at("probability", F.col("label") + 1)
    told = scored.groupBy("epoch").agg(F.count(F.lit(1)).alias("n_rows"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a"), F.avg(-F.log(own)).alias("l"))
    return (
        convnet.history_frame(spark, state)
        .join(told, "epoch")
        .select("epoch", "n_rows", (F.abs(F.col("val_accuracy") - F.col("a")) < 1e-12).alias("same_accuracy"), (F.abs(F.col("val_loss") - F.col("l")) < 1e-9).alias("same_loss"), F.col("accuracy").between(0, 1).alias("is_share"))
    )


@query("conv_predict")
def conv_predict(spark, sf):
    """A saved and loaded network scores all rows, also
    those whose vector cannot be used; the stored values before the last layer
    give the same probabilities."""
    z = _images(spark, sf)
    net = _network(z)
    path = scratch_path(spark, "conv-model")
    convnet.save_fit(spark, _fitted(z, net, 1, batch_size=_batch_size(z)), path)
    state = convnet.load_fit(spark, path)
    bad = M.with_bad_vectors(_embeddings(spark, sf)).select("vec_id", A.standardize("embedding").alias("z"))
    p = convnet.predict(state, bad, "z", hidden_col="hidden")
    w, b = state.weights[-(HIDDEN + 1) * net.classes : -net.classes].reshape(HIDDEN, net.classes), state.weights[-net.classes :]
    table = F.array(*[F.array(*[F.lit(float(x)) for x in np.append(w[:, c], b[c])]) for c in range(net.classes)])
    score = F.transform(table, lambda col: F.aggregate(F.zip_with(F.slice(col, 1, HIDDEN), F.col("hidden"), lambda x, y: x * y), F.element_at(col, -1), lambda s, x: s + x))
    e = F.transform(score, lambda x: F.exp(x - F.array_max("score")))
    again = p.withColumn("score", score).withColumn("e", e).withColumn("total", F.aggregate("e", F.lit(0.0), lambda s, x: s + x))
    far = F.exists(F.zip_with(F.col("probability"), F.col("e"), lambda x, y: F.abs(x - y / F.col("total"))), lambda x: x > 1e-9)
    return again.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("prediction").isNull() & F.col("probability").isNull() & F.col("hidden").isNull()).alias("n_none"),
        F.count_if(~far).alias("n_same_probability"),
        F.count_if(F.col("prediction") == A.argmax("probability")).alias("n_argmax"),
    )


# ------------------------------------------------------------------------ SQL

_TRAIN = f"substr(md5(vec_id::VARCHAR), 1, 1) < '{TRAIN_BELOW}'"
_BAD = "vec_id % 7 IN (0, 1, 2, 3)"

ORACLE = {
    "conv_first_gradient": f"""
WITH t AS (SELECT label FROM embeddings WHERE {_TRAIN}), k AS (SELECT max(label) + 1 AS k FROM embeddings), n AS (SELECT count(*) AS n FROM t)
SELECT cls::INTEGER AS cls, round(n / k - (SELECT count(*) FROM t WHERE label = cls), 6) + 0.0 AS gradient, round(n * ln(k), 6) AS loss,
  (SELECT count(*) FROM t WHERE label = 0) AS n_right, n AS n_rows
FROM k, n, range((SELECT k FROM k)) AS r(cls)""",
    "conv_history": f"""
SELECT epoch::INTEGER AS epoch, (SELECT count(*) FROM embeddings WHERE NOT ({_TRAIN})) AS n_rows, true AS same_accuracy, true AS same_loss, true AS is_share
FROM range(1, {EPOCHS + 1}) AS r(epoch)""",
    "conv_predict": f"""
SELECT count(*) AS n_rows, count(*) FILTER ({_BAD}) AS n_none, count(*) FILTER (NOT ({_BAD})) AS n_same_probability, count(*) FILTER (NOT ({_BAD})) AS n_argmax
FROM embeddings""",
}
