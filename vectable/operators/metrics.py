"""Classifier evaluation as DataFrames.

Input is a predictions frame with a true and a predicted class column. Every
metric comes from one partial/final aggregate over the predictions, the pair
counts (map-side combine, so a dominant class costs nothing extra); everything
after that runs on class-sized frames (k rows, or k x k for the matrix).

Zero-division follows the usual report rule: an undefined precision, recall
or F1 is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.operators.common import materialize


def pair_counts(preds: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """(true, pred, n): the one aggregate over the predictions that every metric
    below can be worked out from. Materialise it and hand it to them as
    ``counts`` to read the predictions once."""
    return preds.groupBy(F.col(true_col).alias("true"), F.col(pred_col).alias("pred")).agg(F.count(F.lit(1)).cast("long").alias("n"))


def class_set(preds: DataFrame, true_col: str, pred_col: str, out_col: str = "cls") -> DataFrame:
    """Classes seen in either column (the default label set of a report)."""
    return (
        preds.select(F.col(true_col).alias(out_col))
        .unionByName(preds.select(F.col(pred_col).alias(out_col)))
        .where(F.col(out_col).isNotNull())
        .distinct()
    )


def _classes(preds: DataFrame, true_col: str, pred_col: str, classes: DataFrame | None) -> DataFrame:
    if classes is None:
        return class_set(preds, true_col, pred_col)
    return classes.select(F.col(classes.columns[0]).alias("cls")).distinct()


def confusion_long(
    preds: DataFrame,
    true_col: str,
    pred_col: str,
    classes: DataFrame | None = None,
    zero_cells: bool = True,
    counts: DataFrame | None = None,
) -> DataFrame:
    """A5: (true, pred, n) for every pair of classes, zero cells included.

    ``classes`` is a one-column frame of class values (default: those seen);
    the k x k grid is the class list exploded next to each class. Rows whose
    true or predicted class is NULL or not in the list keep cells of their
    own, so the matrix always sums to the number of rows.
    """
    counts = pair_counts(preds, true_col, pred_col) if counts is None else counts
    if not zero_cells:
        return counts.select("true", "pred", "n")
    if classes is None:  # read for the classes and for the cells: computed once
        counts = materialize(counts, "pairs")
    cls = _classes(counts, "true", "pred", classes)
    values = cls.select(F.sort_array(F.collect_list("cls"))).scalar()
    grid = cls.withColumn("g_all", values).select(F.col("cls").alias("g_true"), F.explode("g_all").alias("g_pred"))
    met = grid.join(counts, F.col("g_true").eqNullSafe(F.col("true")) & F.col("g_pred").eqNullSafe(F.col("pred")), "full_outer")
    here = F.col("n").isNotNull()
    return met.select(
        F.when(here, F.col("true")).otherwise(F.col("g_true")).alias("true"),
        F.when(here, F.col("pred")).otherwise(F.col("g_pred")).alias("pred"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def confusion_wide(long: DataFrame, class_values: list, names: dict | None = None) -> DataFrame:
    """One row per true class, one column per predicted class.

    ``class_values`` are the predicted classes in column order (the caller
    knows them from the class dictionary); ``names`` optionally maps values to
    column names.
    """
    names = names or {v: str(v) for v in class_values}
    wide = long.groupBy("true").pivot("pred", class_values).agg(F.sum("n").cast("long"))
    return wide.select("true", *[F.coalesce(F.col(str(v)), F.lit(0)).cast("long").alias(names[v]) for v in class_values])


def annotate_confusion(long: DataFrame, x_index: Column | None = None, y_index: Column | None = None) -> DataFrame:
    """R3 + P10 + A16: annotation rows (x = predicted, y = true, text, colour);
    the text is white when the cell exceeds half of the matrix maximum."""
    mx = long.select(F.max("n").alias("m")).scalar()
    x = x_index if x_index is not None else F.col("pred")
    y = y_index if y_index is not None else F.col("true")
    return long.select(
        x.alias("x"),
        y.alias("y"),
        F.col("n").cast("string").alias("text"),
        F.when(F.col("n") > mx / F.lit(2.0), F.lit("white")).otherwise(F.lit("black")).alias("colour"),
    )


def per_class_counts(preds: DataFrame, true_col: str, pred_col: str, counts: DataFrame | None = None) -> DataFrame:
    """(cls, support, predicted, tp) from the pair counts: each cell counts once
    for its true class and once for its predicted class."""
    counts = pair_counts(preds, true_col, pred_col) if counts is None else counts
    t, p, n = F.col("true"), F.col("pred"), F.col("n")
    none = F.lit(0).cast("long")
    entries = F.array(
        F.struct(t.alias("cls"), n.alias("s"), none.alias("p"), F.when(t == p, n).otherwise(none).alias("tp")),
        F.struct(p.alias("cls"), none.alias("s"), n.alias("p"), none.alias("tp")),
    )
    e = counts.select(F.inline(entries)).where(F.col("cls").isNotNull())
    return e.groupBy("cls").agg(
        F.sum("s").cast("long").alias("support"),
        F.sum("p").cast("long").alias("predicted"),
        F.sum("tp").cast("long").alias("tp"),
    )


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double")), F.lit(0.0))


def class_report(
    preds: DataFrame,
    true_col: str,
    pred_col: str,
    classes: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """(cls, precision, recall, f1, support) for every class."""
    c = per_class_counts(preds, true_col, pred_col, counts)
    # Without a list the classes are those that the counts hold.
    j = c if classes is None else _classes(preds, true_col, pred_col, classes).join(c, "cls", "left").na.fill(0, ["support", "predicted", "tp"])
    p = _ratio(F.col("tp"), F.col("predicted"))
    r = _ratio(F.col("tp"), F.col("support"))
    return (
        j.withColumn("precision", p)
        .withColumn("recall", r)
        .withColumn("f1", _ratio(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .select("cls", "precision", "recall", "f1", F.col("support").cast("long").alias("support"))
    )


def report_summary(report: DataFrame, preds: DataFrame, true_col: str, pred_col: str, counts: DataFrame | None = None) -> DataFrame:
    """Accuracy, macro avg and weighted avg rows
    (metric, precision, recall, f1, support); accuracy sits in ``f1``."""
    counts = pair_counts(preds, true_col, pred_col) if counts is None else counts
    hits = F.sum(F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(F.lit(0)))
    acc = counts.agg(
        F.try_divide(hits.cast("double"), F.sum("n").cast("double")).alias("f1"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("support"),
    ).select(
        F.lit("accuracy").alias("metric"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        "f1",
        F.col("support").cast("long").alias("support"),
    )
    total = F.sum("support")
    macro = report.agg(
        F.lit("macro avg").alias("metric"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        total.cast("long").alias("support"),
    )
    weighted = report.agg(
        F.lit("weighted avg").alias("metric"),
        _ratio(F.sum(F.col("precision") * F.col("support")), total).alias("precision"),
        _ratio(F.sum(F.col("recall") * F.col("support")), total).alias("recall"),
        _ratio(F.sum(F.col("f1") * F.col("support")), total).alias("f1"),
        total.cast("long").alias("support"),
    )
    return acc.unionByName(macro).unionByName(weighted)


def accuracy(preds: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """A11."""
    return preds.agg(F.avg((F.col(true_col) == F.col(pred_col)).cast("double")).alias("accuracy"))


def cross_entropy(
    preds: DataFrame, prob_col: str, true_index_col: str, eps: float = 1e-7, out_col: str = "cross_entropy"
) -> DataFrame:
    """Mean of ``-ln(p[true])`` with p clipped to [eps, 1 - eps] (Keras rule);
    ``true_index_col`` is the 0-based position of the true class in ``prob_col``.
    ``n_rows`` counts the rows that the mean is over (those with a probability)."""
    p = F.try_element_at(F.col(prob_col), (F.col(true_index_col) + F.lit(1)).cast("int"))
    clipped = F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps)))
    return preds.agg(F.avg(-F.ln(clipped)).alias(out_col), F.count(clipped).alias("n_rows"))


def loaded_counts(df: DataFrame, valid: Column, batch_size: int = 32) -> DataFrame:
    """A17 + A18: rows read, rows kept after decode, and batches of the kept rows."""
    kept = F.count_if(valid)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        kept.alias("n_loaded"),
        F.ceil(kept / F.lit(float(batch_size))).cast("long").alias("n_batches"),
    )
