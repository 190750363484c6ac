"""Scalar string and array functions."""

from __future__ import annotations

import base64

import numpy as np
import pytest

from vectable.functions import arrays as A
from vectable.functions import text as T


def one(spark, expr, schema="x string", value=("",)):
    return spark.createDataFrame([value], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "path,label",
    [
        ("hdfs://nn:8020/d/train/squamous.cell.carcinoma/7 - Copy (3).png", "squamous_cell_carcinoma"),
        ("file:/x/train/normal/a.png", "normal"),
        ("a.png", None),
    ],
)
def test_label_from_path(spark, path, label):
    assert one(spark, T.label_from_path("x"), value=(path,)) == label


def test_split_from_path(spark):
    assert one(spark, T.split_from_path("x"), value=("/d/valid/normal/a.png",)) == "valid"


@pytest.mark.parametrize(
    "raw,display",
    [("large_cell_carcinoma", "Large cell carcinoma"), ("NORMAL", "Normal"), ("", ""), ("x", "X")],
)
def test_display_label_is_capitalize_not_initcap(spark, raw, display):
    assert one(spark, T.display_label("x"), value=(raw,)) == display == raw.replace("_", " ").capitalize()


def test_slug(spark):
    assert one(spark, T.label_slug("x"), value=("Large Cell Carcinoma",)) == "large_cell_carcinoma"


@pytest.mark.parametrize("name,ok", [("a.PNG", True), ("a.jpeg", True), ("xjpg", True), ("a.gif", False), ("png.txt", False)])
def test_suffix_no_dot_case_insensitive(spark, name, ok):
    assert one(spark, T.has_suffix("x"), value=(name,)) is ok


@pytest.mark.parametrize("v", [0.125, 0.145, 0.155, 1.005, 2.675, 0.625, 0.375, 1234.565, -0.145, 98.7654321])
def test_fixed_rounds_like_python(spark, v):
    r = spark.createDataFrame([(v,)], "x double").select(T.fixed("x", 2).alias("a"), T.fixed4("x").alias("b")).first()
    assert (r["a"], r["b"]) == (f"{v:.2f}", f"{v:.4f}")


def test_percent_and_fixed(spark):
    assert one(spark, T.percent_text("x"), "x double", (0.98765,)) == "98.77%"
    assert one(spark, T.fixed4("x"), "x double", (0.87654321,)) == "0.8765"


def test_data_uri_roundtrip_long_payload(spark):
    payload = bytes(range(256)) * 40  # > 76 chars of base64: no line breaks allowed
    uri = one(spark, T.data_uri_encode("x"), "x binary", (bytearray(payload),))
    assert uri == "data:image/png;base64," + base64.b64encode(payload).decode()
    back = one(spark, T.data_uri_payload("x"), value=(uri,))
    assert bytes(back) == payload


def test_standardize_properties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=50)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    out = {r["id"]: np.array(r["z"]) for r in df.select("id", A.standardize("v").alias("z")).collect()}
    for i, v in rows:
        exp = (np.array(v) - np.mean(v)) / np.std(v)
        assert np.allclose(out[i], exp, atol=1e-12)
        assert abs(out[i].mean()) < 1e-12 and abs(out[i].std() - 1) < 1e-12


def test_standardize_constant_row(spark):
    df = spark.createDataFrame([([2.0, 2.0, 2.0],)], "v array<double>")
    r = df.select(A.standardize("v").alias("a"), A.standardize("v", 1e-7).alias("b")).first()
    assert r["a"] == [None, None, None]
    assert r["b"] == [0.0, 0.0, 0.0]


def test_standardize_stats_not_inlined_per_element(spark):
    """The per-row mean must not be recomputed inside the element lambda."""
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>").select(A.standardize("v").alias("z"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # Only the zip_with partner (array_repeat) may hold the statistics.
    assert "array_repeat" in plan


@pytest.mark.parametrize("p,idx", [([0.1, 0.7, 0.2], 1), ([0.4, 0.1, 0.4], 0), ([0.5], 0)])
def test_argmax_first_maximum(spark, p, idx):
    r = spark.createDataFrame([(p,)], "p array<double>").select(A.argmax("p").alias("i"), A.confidence("p").alias("c")).first()
    assert r["i"] == idx == int(np.argmax(p))
    assert r["c"] == max(p)


def test_softmax_sums_to_one(spark):
    d = [3.0, 1.0, 2.0, 10.0]
    r = spark.createDataFrame([(d,)], "d array<double>").select(A.softmax_neg("d").alias("p")).first()["p"]
    e = np.exp(-(np.array(d) - min(d)))
    assert np.allclose(r, e / e.sum())
    assert abs(sum(r) - 1) < 1e-12
