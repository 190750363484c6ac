"""The end-to-end job on the generated image tree."""

from __future__ import annotations

import base64
import os

import numpy as np
from pyspark.sql import functions as F

from conftest import write_png
from vectable.functions.png import decode_png
from vectable.job import run_training_job
from vectable.operators import convnet


def test_training_job(spark, image_tree, tmp_path):
    base, _ = image_tree
    os.makedirs(os.path.join(base, "train/no.files"), exist_ok=True)
    out = str(tmp_path / "out")
    res = run_training_job(spark, base, out, size=(8, 8), max_iter=5, dashboard=True)
    # labels over all splits, sorted: adeno, empty_class, large_cell_x, nested?, normal
    dim = {r["label"]: r["label_index"] for r in spark.read.parquet(f"{out}/label_dictionary").collect()}
    assert dim == {"adeno": 0, "empty_class": 1, "large_cell_x": 2, "normal": 3}
    assert res["classes"] == 4
    rej = {os.path.basename(r["path"]): r["reason"] for r in spark.read.parquet(f"{out}/rejects").collect()}
    assert rej == {"bad.png": "undecodable image", "placeholder": "undecodable image", "flat.png": "constant image"}
    assert res["counts"] == {"train": 5, "test": 4, "valid": 1} and res["loaded"] == {"train": 4, "test": 3}
    preds = spark.read.schema("image_path string, true_label string, predicted_label string").option("header", True).csv(f"{out}/predictions")
    assert preds.count() == 3
    assert preds.where(F.col("predicted_label").isNull()).count() == 0
    conf = spark.read.parquet(f"{out}/confusion")
    assert conf.count() == 16 and conf.agg(F.sum("n")).first()[0] == 3
    assert 0.0 <= res["accuracy"] <= 1.0
    wide = spark.read.parquet(f"{out}/confusion_wide")
    assert wide.columns == ["true", "adeno", "empty_class", "large_cell_x", "normal"]
    dist = {(r["Dataset"], r["Class"]): r["Images"] for r in spark.read.parquet(f"{out}/class_distribution").collect()}
    assert dist[("Valid", "Empty class")] == 0
    assert dist[("Train", "No files")] == 0  # a folder without any file
    spot = {r["split"]: r for r in spark.read.parquet(f"{out}/spot_checks").collect()}
    # first valid file is the placeholder: no image, so no prediction
    assert spot["valid"]["true_label"] == "empty_class" and spot["valid"]["predicted_label"] is None
    assert spot["test"]["true_label"] == "adeno" and spot["test"]["predicted_label"] is not None
    assert spark.read.parquet(f"{out}/history").count() >= 2
    b = spark.read.parquet(f"{out}/batches").collect()
    assert sum(r["n_rows"] for r in b) == res["train_rows"] == 4
    means = {r["label"]: r["mean"] for r in spark.read.parquet(f"{out}/mean_images").collect()}
    assert set(means) == {"large_cell_x", "normal"} and len(means["normal"]) == 8 * 8 * 3
    assert all(0 <= x <= 255 for x in means["normal"])
    uris = {r["label"]: r["uri"] for r in spark.read.parquet(f"{out}/mean_images").collect()}
    assert decode_png(base64.b64decode(uris["normal"].split(",")[1])).reshape(-1).tolist() == means["normal"]
    xy = spark.read.parquet(f"{out}/latent_2d")
    assert xy.count() == 4 and xy.columns == ["path", "x", "y", "label"]


def test_caps_apply_before_undecodable_rows_drop(spark, image_tree, tmp_path):
    base, _ = image_tree
    res = run_training_job(spark, base, str(tmp_path / "o"), size=(8, 8), max_iter=2, train_cap=5, test_cap=2)
    # train files in path order: 2 large.cell.x, UP.PNG, a.jpg.png, bad.png -> bad.png drops
    assert res["train_rows"] == 4
    # test files in path order: x.png, flat.png -> the constant one drops
    assert res["test_rows"] == 1


def test_bad_training_images_do_not_end_the_job(spark, tmp_path):
    """A flat, a corrupt and a wrong-size image, and a decodable file of any name, in train."""
    rng = np.random.default_rng(3)
    base = tmp_path / "tree"
    for split in ("train", "test"):
        for label in ("a", "b"):
            for i in range(3):
                write_png(str(base / split / label / f"{i}.png"), rng.integers(0, 256, (6, 6, 3)))
    write_png(str(base / "train/a/flat.png"), np.full((6, 6, 3), 9))
    write_png(str(base / "train/a/wide.png"), rng.integers(0, 256, (3, 20, 3)))
    write_png(str(base / "train/b/scan01"), rng.integers(0, 256, (6, 6, 3)))
    (base / "train/b/broken.png").write_bytes(b"no image")
    res = run_training_job(spark, str(base), str(tmp_path / "o"), size=(6, 6), max_iter=3)
    assert res["counts"] == {"train": 10, "test": 6} and res["loaded"] == {"train": 8, "test": 6}
    assert res["train_rows"] == 8 and res["test_rows"] == 6


def test_job_cli_error_code(tmp_path, capsys):
    from vectable import job

    rc = job.main(["--base", str(tmp_path / "missing"), "--out", str(tmp_path / "o"), "--master", "local[1]"])
    assert rc == 1
    assert "ERROR" in capsys.readouterr().err


def test_job_with_the_convolutional_network(spark, image_tree, tmp_path):
    base, _ = image_tree
    out = str(tmp_path / "conv")
    res = run_training_job(spark, base, out, size=(8, 8), network="conv", latent="neighbours", epochs=3, same_padding=True, batch_size=3, dashboard=True)
    history = spark.read.parquet(f"{out}/history").orderBy("epoch").collect()
    assert [r["epoch"] for r in history] == [1, 2, 3] and res["final_loss"] == history[-1]["loss"]
    assert all(0 <= r["accuracy"] <= 1 and r["val_loss"] is None for r in history)  # no usable valid image
    state = convnet.load_fit(spark, f"{out}/model")
    assert state.network.classes == 4 and state.steps == 6
    assert spark.read.parquet(f"{out}/confusion").agg(F.sum("n")).first()[0] == 3
    assert spark.read.parquet(f"{out}/latent_2d").count() == 4
