"""File sources, image decode and quality on a generated tree (FIXTURES.md §3)."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectable.operators import images as I
from vectable.operators import labels, quality, reports, vectors
from vectable.sources import files


def test_labelled_files_two_levels(spark, image_tree):
    base, _ = image_tree
    df = files.labelled_files(spark, os.path.join(base, "train"))
    got = sorted((r["label"], os.path.basename(r["path"])) for r in df.collect())
    # stray file beside the class folders and the nested folder are excluded
    assert got == [
        ("large_cell_x", "0 - Copy (0).png"),
        ("large_cell_x", "1.png"),
        ("normal", "UP.PNG"),
        ("normal", "a.jpg.png"),
        ("normal", "bad.png"),
    ]
    assert reports.schema_text(df) == "struct<content:binary,path:string,label:string>"
    first = reports.peek(df.select("path", "label"), 1, ["path"]).first()
    assert first["path"].endswith("0 - Copy (0).png")


def test_listing_reads_no_bytes_and_keeps_empty_class(spark, image_tree):
    base, _ = image_tree
    lst = files.listing(spark, base)
    plan = lst._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    dist = {(r["Dataset"], r["Class"]): r["Images"] for r in labels.class_distribution(lst, "split", "label", F.col("is_image")).collect()}
    assert dist[("Valid", "Empty class")] == 0
    assert dist[("Train", "Normal")] == 3  # UP.PNG, a.jpg.png, bad.png (name test only)
    assert dist[("Test", "Normal")] == 3
    assert dist[("Train", "Large cell x")] == 2


def test_images_decode_rgb_and_rejects(spark, image_tree):
    base, px = image_tree
    imgs = files.labelled_images(spark, base)
    rej = [os.path.basename(r["path"]) for r in quality.image_rejects(imgs).collect()]
    assert rej == ["bad.png"]
    vec = I.image_vectors(imgs, size=(4, 4), standardize=False)
    rows = {r["path"].split("/", 1)[1].split(base.lstrip("/"), 1)[-1].lstrip("/"): r for r in vec.collect()}
    assert "train/large.cell.x/0 - Copy (0).png" in rows  # percent-decoded origin
    assert rows["train/normal/UP.PNG"]["label"] == "normal"
    grey = np.array(rows["test/normal/grey.png"]["vector"]).reshape(4, 4, 3)
    assert np.allclose(grey[:, :, 0], grey[:, :, 1]) and np.allclose(grey[:, :, 1], grey[:, :, 2])
    same = np.array(rows["train/normal/UP.PNG"]["vector"]).reshape(4, 4, 3)
    assert np.allclose(same, px["train/normal/UP.PNG"].astype(np.float32))  # 4x4 -> 4x4, RGB order kept
    rgba = np.array(rows["test/normal/rgba.png"]["vector"]).reshape(4, 4, 3)
    assert rgba.shape == (4, 4, 3)


def test_standardised_image_vectors(spark, image_tree):
    base, _ = image_tree
    imgs = files.labelled_images(spark, base, splits=["test"])
    vec = {os.path.basename(r["path"]): r["vector"] for r in I.image_vectors(imgs, size=(8, 8)).collect()}
    assert vec["flat.png"] is None  # constant image, eps = 0
    v = np.array(vec["x.png"], dtype=np.float64)
    assert abs(v.mean()) < 1e-5 and abs(v.std() - 1) < 1e-4
    eps = {os.path.basename(r["path"]): np.array(r["vector"]) for r in I.image_vectors(imgs, size=(8, 8), eps=1e-7).collect()}
    assert np.allclose(eps["flat.png"], 0)


def test_mean_image_truncated(spark, image_tree):
    base, px = image_tree
    imgs = files.labelled_images(spark, base, splits=["train"]).where(F.col("label") == "large_cell_x")
    vec = I.image_vectors(imgs, size=(6, 5), standardize=False)
    m = vectors.class_means_truncated(vec, "label", "vector").first()["mean"]
    a = px["train/large.cell.x/0 - Copy (0).png"].astype(np.float32)
    b = px["train/large.cell.x/1.png"].astype(np.float32)
    assert m == list(np.mean([a, b], axis=0).astype(np.uint8).reshape(-1).astype(int))


def test_require_rows(spark):
    with pytest.raises(quality.EmptyInputError):
        quality.require_rows(spark.range(0), "train split")


def test_csv_and_dump_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b"\x00\x01" * 100), "p/a b (1).png", "x", 0)], "content binary, path string, label string, label_index int")
    files.write_csv(df.drop("content"), str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "path string, label string, label_index int").collect()
    assert [tuple(r) for r in back] == [("p/a b (1).png", "x", 0)]
    files.write_csv(df, str(tmp_path / "csvb"))
    b64 = files.read_csv(spark, str(tmp_path / "csvb"), "content string, path string, label string, label_index int")
    assert bytes(b64.select(F.unbase64("content")).first()[0]) == b"\x00\x01" * 100
    files.write_dump(df, str(tmp_path / "dump"), ["label"])
    d = files.read_dump(spark, str(tmp_path / "dump")).first()
    assert bytes(d["content"]) == b"\x00\x01" * 100 and d["label"] == "x"
    files.write_dump(df.withColumn("label", F.lit("01")), str(tmp_path / "dump2"), ["label"])
    assert files.read_dump(spark, str(tmp_path / "dump2"), df.schema).first()["label"] == "01"


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from vectable.session import checkpoint_root

    conf = SimpleNamespace(get=lambda k, d=None: d)
    for master in ("local-cluster[3,1,1024]", "spark://host:7077", "yarn"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(SimpleNamespace(conf=conf, sparkContext=sc))


def test_every_file_is_decoded_or_rejected(spark, image_tree):
    base, _ = image_tree
    imgs = files.labelled_images(spark, base, only_image_names=False)
    vec = I.image_vectors(imgs, size=(4, 4), keep_undecodable=True)
    got = {os.path.basename(r["path"]): r["vector"] is not None for r in vec.collect()}
    assert got["placeholder"] is False and got["bad.png"] is False and got["flat.png"] is False
    assert sum(got.values()) == 7 and len(got) == files.listing(spark, base).count()
