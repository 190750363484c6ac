"""Classifier fit / apply on Spark ML.

The reference trains a small network on the driver. Here the network is
Spark ML's ``MultilayerPerceptronClassifier`` (layers ``[d, 64, k]``, sigmoid
hidden layer, softmax output), trained with distributed L-BFGS: every
iteration is one pass of gradient aggregation over the partitions, and only
the weight vector (d*64 + 64*k + 64 + k doubles) travels to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.functions import arrays as A
from vectable.operators.common import computed_once, materialize
from vectable.operators.quality import unusable

FEATURES = "features"


def with_features(df: DataFrame, vec_col: str, out_col: str = FEATURES) -> DataFrame:
    """Array column -> ML dense vector (double)."""
    return df.withColumn(out_col, array_to_vector(A.as_double_array(vec_col)))


def fit_classifier(
    train: DataFrame,
    vec_col: str,
    label_col: str,
    n_classes: int,
    hidden: int = 64,
    max_iter: int = 100,
    seed: int = 42,
    block_size: int = 128,
) -> PipelineModel:
    """K1: fit ``[d, hidden, n_classes]`` on rows with a label index in
    ``0 .. n_classes-1`` and a usable vector. ``d`` is the length of a usable
    row; rows whose vector cannot be used (``quality.unusable``) take no part."""
    rows = computed_once(train.select(label_col, vec_col))
    first = rows.where(~unusable(vec_col)).select(F.size(vec_col).alias("d")).where(F.col("d") > 0).first()
    if first is None:
        raise ValueError("no training rows")
    d = int(first["d"])
    data = with_features(rows.where(~unusable(vec_col, d)), vec_col).withColumn("__label", F.col(label_col).cast("double"))
    mlp = MultilayerPerceptronClassifier(
        featuresCol=FEATURES,
        labelCol="__label",
        layers=[d, hidden, n_classes],
        maxIter=max_iter,
        seed=seed,
        blockSize=block_size,
        solver="l-bfgs",
    )
    return Pipeline(stages=[mlp]).fit(data)


def _mlp(model: PipelineModel) -> MultilayerPerceptronClassificationModel:
    return model.stages[-1]


def predict(model: PipelineModel, df: DataFrame, vec_col: str, pred_col: str = "prediction") -> DataFrame:
    """K2 + K5: ``prediction`` (int class index, first maximum) and
    ``probability`` (array<double>). Rows whose vector cannot be used (NULL,
    another length, a NULL or non-finite element) keep a NULL prediction (K3:
    a failed item yields None, not an error).

    One pass: an unusable vector is scored as zeros and its outputs are nulled
    afterwards, so the input is neither split nor read twice."""
    d = _mlp(model).numFeatures
    rows = computed_once(df)
    flagged = computed_once(rows.withColumn("__missing", unusable(vec_col, d)))
    missing = F.col("__missing")
    filled = F.when(missing, F.array_repeat(F.lit(0.0), d)).otherwise(A.as_double_array(vec_col))
    scored = model.transform(flagged.withColumn(FEATURES, array_to_vector(filled)))
    return scored.select(
        *df.columns,
        F.when(~missing, F.col("prediction").cast("int")).alias(pred_col),
        F.when(~missing, vector_to_array("probability")).alias("probability"),
    )


def training_history(model: PipelineModel) -> list[tuple[int, float]]:
    """K6: (iteration, loss) of the fit; entry 0 is the starting loss.
    Bounded by ``max_iter``."""
    hist = _mlp(model).summary().objectiveHistory
    return [(i, float(v)) for i, v in enumerate(hist)]


def history_frame(spark, model: PipelineModel) -> DataFrame:
    return spark.createDataFrame(training_history(model), "iteration int, loss double")


def _layer_weights(model: PipelineModel) -> tuple[np.ndarray, np.ndarray]:
    """Hidden layer (W: hidden x d, b: hidden) from the flat weight vector.

    Spark stores each affine layer as an out x in column-major matrix followed
    by the bias."""
    m = _mlp(model)
    layers = list(m.getLayers())
    d, h = layers[0], layers[1]
    w = m.weights.toArray()
    W = w[: d * h].reshape(d, h).T
    b = w[d * h : d * h + h]
    return W, b


def hidden_features(model: PipelineModel, df: DataFrame, vec_col: str, out_col: str = "hidden") -> DataFrame:
    """K7: activations of the layer before the classifier, sigmoid(W x + b).

    The layer weights are a Spark broadcast variable (size d x hidden); each
    Arrow batch is one matrix product on the executor."""
    spark = df.sparkSession
    W, b = _layer_weights(model)
    bc = spark.sparkContext.broadcast((W.astype(np.float64), b.astype(np.float64)))
    cols = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out_col}` array<double>"

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Wl, bl = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            vecs = [None if v is None else np.asarray([np.nan if x is None else x for x in v], dtype=np.float64) for v in pdf[vec_col]]
            ok = np.array([v is not None and len(v) == Wl.shape[1] and bool(np.isfinite(v).all()) for v in vecs])
            hidden = [None] * len(pdf)
            if ok.any():
                X = np.stack([v for v, k in zip(vecs, ok) if k])
                H = 1.0 / (1.0 + np.exp(-(X @ Wl.T + bl)))
                for i, h in zip(np.flatnonzero(ok), H):
                    hidden[i] = h
            out = pdf[cols].copy()
            out[out_col] = hidden
            yield out

    # Rows without a usable vector get a NULL feature vector (no filter in front of
    # the Python step, which could recompute a derived vector column).
    return df.mapInPandas(fn, schema)


def project_2d(df: DataFrame, vec_col: str, id_cols: list[str], label_col: str) -> DataFrame:
    """K8: 2-D projection of feature vectors (PCA, k = 2) for a scatter of
    (x, y) coloured by label. Fewer than 2 rows give an empty frame of the same
    columns and types."""
    # PCA makes several passes over its input; cut the lineage once (shared
    # checkpoint folder) so upstream work, e.g. a Python feature pass, runs once.
    data = with_features(materialize(df, "pca-input").where(F.col(vec_col).isNotNull()), vec_col, "__f")
    if data.limit(2).count() < 2:
        none = F.lit(None).cast("double")
        return df.select(*id_cols, none.alias("x"), none.alias("y"), label_col).limit(0)
    pca = PCA(k=2, inputCol="__f", outputCol="__p").fit(data)
    out = pca.transform(data).select(*id_cols, label_col, vector_to_array("__p").alias("__xy"))
    return out.select(*id_cols, F.col("__xy")[0].alias("x"), F.col("__xy")[1].alias("y"), label_col)


def save_model(model: PipelineModel, path: str) -> None:
    """S10."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load once per job; the model is then applied to whole frames."""
    return PipelineModel.load(path)


def user_model_udf(make_predict_fn, return_type=None, batch_size: int = 32, input_shape=None):
    """Wrap a user's own model (any callable on a NumPy batch) as an
    Arrow-batched prediction UDF; the model is built once per Python worker.

    ``make_predict_fn`` returns ``predict(batch: np.ndarray) -> np.ndarray``.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType

    return predict_batch_udf(
        make_predict_fn,
        return_type=return_type or ArrayType(DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=[input_shape] if input_shape else None,
    )
