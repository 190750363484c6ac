"""Report tables (R1, R4, R6, P11, P12): the data behind the charts and text
reports, as DataFrames. Drawing is out of scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.functions.text import fixed


def history_long(history: DataFrame, epoch_col: str, series: Sequence[str]) -> DataFrame:
    """Wide history (epoch, s1, s2, ...) -> long (epoch, variable, value)."""
    h = history.select(epoch_col, *[F.col(s).cast("double").alias(s) for s in series])
    return h.unpivot([epoch_col], list(series), "variable", "value")


def history_last(history: DataFrame, epoch_col: str, series: Sequence[str]) -> DataFrame:
    """The value of each series at the last epoch, plus that epoch."""
    return history.agg(
        F.max(epoch_col).alias("last_epoch"),
        *[F.max_by(F.col(s).cast("double"), F.col(epoch_col)).alias(f"final_{s}") for s in series],
    )


# Fixed values of the text report layout: column titles, field width, and the
# longest summary row name (which sets the minimum width of the name column).
REPORT_HEADERS = ("precision", "recall", "f1-score", "support")
REPORT_FIELD_WIDTH = 9
REPORT_LONGEST_SUMMARY = "weighted avg"


def rjust(s: Column, width: Column | int) -> Column:
    """Right-align ``s`` in ``width`` characters without ever cutting it
    (``lpad`` truncates longer strings, e.g. a support count of 10 digits)."""
    w = width if isinstance(width, Column) else F.lit(width)
    return F.concat(F.repeat(F.lit(" "), F.greatest(w - F.length(s), F.lit(0))), s)


def report_text(report: DataFrame, summary: DataFrame, name_col: str = "name", digits: int = 2) -> DataFrame:
    """The classification report as aligned text lines (row_name, section,
    line): a header (section 0), one line per class (1), then accuracy,
    macro avg and weighted avg (2). The name column is as wide as the longest
    class name or "weighted avg"; each field is right-aligned in 9 characters
    after one space; numbers are written as Python's ``f"{x:.{digits}f}"``.

    ``report`` rows carry ``name_col`` (class name), ``summary`` rows carry
    ``metric``. The width is one aggregate over the class-sized report.
    """
    fw = REPORT_FIELD_WIDTH
    width_row = report.agg(
        F.greatest(
            F.coalesce(F.max(F.length(F.col(name_col).cast("string"))), F.lit(0)),
            F.lit(len(REPORT_LONGEST_SUMMARY)),
            F.lit(digits),
        ).alias("__w")
    )
    width = width_row.select("__w").scalar()

    def num(c):
        return F.when(F.col(c).isNull(), F.lit("")).otherwise(fixed(F.col(c), digits))

    def line(name: Column, fields: list[Column], w: Column) -> Column:
        parts = [rjust(name, w), F.lit(" ")]
        for f in fields:
            parts += [F.lit(" "), rjust(f, fw)]
        return F.concat(*parts)

    header = width_row.select(
        F.lit("").alias("row_name"),
        F.lit(0).alias("section"),
        line(F.lit(""), [F.lit(h) for h in REPORT_HEADERS], F.col("__w")).alias("line"),
    )

    def rows(df: DataFrame, name: Column, section: int) -> DataFrame:
        fields = [num("precision"), num("recall"), num("f1"), F.col("support").cast("string")]
        return df.select(name.alias("row_name"), F.lit(section).alias("section"), line(name, fields, width).alias("line"))

    return header.unionByName(rows(report, F.col(name_col).cast("string"), 1)).unionByName(
        rows(summary, F.col("metric"), 2)
    )


def records_json(df: DataFrame, out_col: str = "record") -> DataFrame:
    """Each row as a JSON object (field order = column order)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out_col))


def predictions_table(preds: DataFrame, path_col: str, true_name_col: str, pred_name_col: str) -> DataFrame:
    """P12 / R6 / S7 layout: image_path, true_label, predicted_label (strings)."""
    return preds.select(
        F.col(path_col).cast("string").alias("image_path"),
        F.col(true_name_col).cast("string").alias("true_label"),
        F.col(pred_name_col).cast("string").alias("predicted_label"),
    )


def schema_text(df: DataFrame) -> str:
    """The schema as one line (``printSchema`` without printing)."""
    return df.schema.simpleString()


def peek(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (``show(n)`` made
    deterministic)."""
    return df.orderBy(*order).limit(n)
