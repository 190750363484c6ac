"""
recomputed by our metric operators from the confusion matrices."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vectable.operators import metrics

# Class names and golden confusion matrices (rows = true, columns = predicted).
CLASSES = ["adenocarcinoma", "large_cell_carcinoma", "normal", "squamous_cell_carcinoma"]
SAVED_PREDICTIONS = [[0, 0, 4, 74], [2, 0, 2, 14], [0, 0, 44, 1], [0, 0, 0, 59]]
DASHBOARD = [[20, 32, 0, 26], [3, 10, 0, 5], [0, 1, 43, 1], [4, 21, 0, 34]]


def _preds(spark, matrix):
    cells = [(CLASSES[i], CLASSES[j], n) for i, row in enumerate(matrix) for j, n in enumerate(row) if n]
    df = spark.createDataFrame(cells, "t string, p string, n int")
    return df.select("t", "p", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k")).drop("k")


def _classes(spark):
    return spark.createDataFrame([(c,) for c in CLASSES], "cls string")


def test_saved_predictions_report(spark):
    preds = _preds(spark, SAVED_PREDICTIONS)
    rep = {r["cls"]: r for r in metrics.class_report(preds, "t", "p", _classes(spark)).collect()}
    assert rep["adenocarcinoma"]["support"] == 78 and rep["adenocarcinoma"]["precision"] == 0.0
    assert rep["large_cell_carcinoma"]["precision"] == 0.0  # never predicted: zero division -> 0
    assert rep["normal"]["precision"] == pytest.approx(0.8800, abs=1e-4)
    assert rep["normal"]["recall"] == pytest.approx(0.9778, abs=1e-4)
    assert rep["normal"]["f1"] == pytest.approx(0.9263, abs=1e-4)
    assert rep["squamous_cell_carcinoma"]["precision"] == pytest.approx(0.3986, abs=1e-4)
    assert rep["squamous_cell_carcinoma"]["f1"] == pytest.approx(0.5700, abs=1e-4)
    summ = {r["metric"]: r for r in metrics.report_summary(metrics.class_report(preds, "t", "p", _classes(spark)), preds, "t", "p").collect()}
    assert summ["accuracy"]["f1"] == pytest.approx(0.515, abs=1e-9)
    assert summ["accuracy"]["support"] == 200
    assert summ["macro avg"]["precision"] == pytest.approx(0.3197, abs=1e-4)
    assert summ["macro avg"]["recall"] == pytest.approx(0.4944, abs=1e-4)
    assert summ["macro avg"]["f1"] == pytest.approx(0.3741, abs=1e-4)
    assert summ["weighted avg"]["precision"] == pytest.approx(0.3156, abs=1e-4)
    assert summ["weighted avg"]["recall"] == pytest.approx(0.5150, abs=1e-4)
    assert summ["weighted avg"]["f1"] == pytest.approx(0.3766, abs=1e-4)


def test_saved_predictions_matrix_roundtrip(spark):
    preds = _preds(spark, SAVED_PREDICTIONS)
    long = metrics.confusion_long(preds, "t", "p", _classes(spark))
    assert long.count() == 16
    wide = {r["true"]: r for r in metrics.confusion_wide(long, CLASSES).collect()}
    for i, c in enumerate(CLASSES):
        assert [wide[c][d] for d in CLASSES] == SAVED_PREDICTIONS[i]


def test_dashboard_accuracy_and_emphasis(spark):
    preds = _preds(spark, DASHBOARD)
    acc = metrics.accuracy(preds, "t", "p").first()[0]
    assert acc == pytest.approx(0.535)
    long = metrics.confusion_long(preds, "t", "p", _classes(spark))
    ann = metrics.annotate_confusion(long).collect()
    white = sorted(int(r["text"]) for r in ann if r["colour"] == "white")
    assert white == [26, 32, 34, 43]  # cells above max/2 = 21.5


def _python_report_lines(matrix, names, digits=2):
    """The usual aligned text report, written directly in Python."""
    k = len(names)
    rows = []
    for i in range(k):
        tp, sup, pred = matrix[i][i], sum(matrix[i]), sum(matrix[r][i] for r in range(k))
        p = tp / pred if pred else 0.0
        r = tp / sup if sup else 0.0
        f = 2 * p * r / (p + r) if p + r else 0.0
        rows.append((names[i], p, r, f, sup))
    total = sum(x[4] for x in rows)
    acc = sum(matrix[i][i] for i in range(k)) / total
    macro = [sum(x[j] for x in rows) / k for j in (1, 2, 3)]
    weighted = [sum(x[j] * x[4] for x in rows) / total for j in (1, 2, 3)]
    width = max(max(len(n) for n in names), len("weighted avg"), digits)
    out = ["{:>{w}s} ".format("", w=width) + " {:>9}" * 4]
    out[0] = out[0].format("precision", "recall", "f1-score", "support")
    fmt = "{:>{w}s} " + " {:>9.{d}f}" * 3 + " {:>9}"
    out += [fmt.format(*x, w=width, d=digits) for x in rows]
    out.append(("{:>{w}s} " + " {:>9}" * 2 + " {:>9.{d}f}" + " {:>9}").format("accuracy", "", "", acc, total, w=width, d=digits))
    out.append(fmt.format("macro avg", *macro, total, w=width, d=digits))
    out.append(fmt.format("weighted avg", *weighted, total, w=width, d=digits))
    return out


def test_report_text_layout(spark):
    from vectable.operators import reports

    preds = _preds(spark, SAVED_PREDICTIONS)
    rep = metrics.class_report(preds, "t", "p", _classes(spark)).withColumnRenamed("cls", "name")
    summ = metrics.report_summary(rep, preds, "t", "p")
    got = [r["line"] for r in reports.report_text(rep, summ).orderBy("section", "row_name").collect()]
    exp = _python_report_lines(SAVED_PREDICTIONS, CLASSES)
    order = {"accuracy": 0, "macro avg": 1, "weighted avg": 2}
    got_sorted = got[:5] + sorted(got[5:], key=lambda l: order[l.strip().split("  ")[0]])
    assert got_sorted == exp
    print("\n".join(exp))
