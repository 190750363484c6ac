"""Dictionary maps (F19), grid completion (J3), bounded lists (L10),
user-model UDF (X4), single-file read (S5), image stream (T1)."""

from __future__ import annotations

import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.operators import labels, model
from vectable.operators.common import DimensionTooLarge, bounded_dimension
from vectable.operators.images import image_vectors
from vectable.sources import files
from vectable.streaming import files as stream


def test_dictionary_maps(spark):
    dim = labels.label_dictionary(spark.createDataFrame([("b",), ("a",)], "label string"))
    fwd, inv = labels.dictionary_maps(dim)
    r = spark.createDataFrame([("a", 1)], "l string, i int").select(fwd[F.col("l")].alias("x"), inv[F.col("i")].alias("y")).first()
    assert (r["x"], r["y"]) == (0, "b")


def test_grid_completion(spark):
    classes = spark.createDataFrame([("x",), ("y",)], "label string")
    grid = labels.class_grid(classes, ["train", "test"])
    counts = spark.createDataFrame([("train", "x", 3)], "split string, label string, Images long")
    out = {(r["split"], r["label"]): r["Images"] for r in labels.complete_counts(counts, grid, ["split", "label"]).collect()}
    assert out == {("train", "x"): 3, ("train", "y"): 0, ("test", "x"): 0, ("test", "y"): 0}


def test_bounded(spark):
    assert labels.column_values(spark.range(3), "id") == [0, 1, 2]
    with pytest.raises(ValueError):
        labels.column_values(spark.range(5), "id", max_rows=4)
    with pytest.raises(DimensionTooLarge):
        bounded_dimension(spark.range(10), 9)
    assert bounded_dimension(spark.range(10), 10).count() == 10


def test_user_model_udf(spark):
    def make():
        w = np.array([1.0, -1.0])

        def predict(x):
            return np.stack([x @ w, -(x @ w)], axis=1)

        return predict

    udf = model.user_model_udf(make, batch_size=2, input_shape=[2])
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 1.0],), ([0.0, 0.0],)], "v array<double>")
    out = [r["p"] for r in df.select(udf("v").alias("p")).collect()]
    assert out == [[-1.0, 1.0], [2.0, -2.0], [0.0, -0.0]]


def test_single_file(spark, image_tree):
    base, _ = image_tree
    p = os.path.join(base, "train/normal/UP.PNG")
    r = files.single_file(spark, p).first()
    assert bytes(r["content"]) == open(p, "rb").read()


def test_image_stream_scores_arrivals(spark, image_tree, tmp_path):
    base, _ = image_tree
    src = tmp_path / "uploads"
    shutil.copytree(os.path.join(base, "test"), src / "test")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def decode(batch):
        return image_vectors(batch, (4, 4), standardize=False).select("path", "label", F.size("vector").alias("n"))

    stream.run_available_now(stream.image_stream(spark, str(src)), out, ck, transform=decode)
    got = {os.path.basename(r["path"]): (r["label"], r["n"]) for r in stream.read_sink(spark, out).collect()}
    assert got == {"grey.png": ("normal", 48), "rgba.png": ("normal", 48), "flat.png": ("normal", 48), "x.png": ("adeno", 48)}
