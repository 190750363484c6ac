"""Row quality: decodable filter (P6), reject table (P7), non-empty guard
(P8) and vector shape rules (F17 per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.functions import arrays as A
from vectable.operators.common import computed_once


class EmptyInputError(ValueError):
    """A required input frame has no rows."""


def decodable(images: DataFrame) -> DataFrame:
    """Keep rows the image source could decode (invalid rows have height -1)."""
    return images.where(F.col("height") > 0)


def image_rejects(images: DataFrame) -> DataFrame:
    """The anti-side of P6 as (path, reason)."""
    return images.where(~(F.col("height") > 0) | F.col("height").isNull()).select(
        "path", F.lit("undecodable image").alias("reason")
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when ``df`` is empty (one cheap ``LIMIT 1`` job)."""
    if df.isEmpty():
        raise EmptyInputError(f"no rows in {what}")
    return df


def unusable(vec_col: str, dim: int | None = None) -> Column:
    """Whether a vector cannot be used: NULL, of another length than ``dim``,
    or with a NULL or non-finite element. The one rule of class means, fits
    and scoring."""
    v = F.col(vec_col)
    bad = v.isNull() | F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    bad = bad if dim is None else bad | (F.size(v) != dim)
    return F.coalesce(bad, F.lit(True))


def vector_reject_reason(vec_col: str, dim: int) -> Column:
    """Why a vector row cannot be used (NULL when it can): missing, wrong
    length, a NULL or non-finite element, or a constant row (std 0, so
    standardising is undefined)."""
    v = F.col(vec_col)
    sd = A.row_stats(v)["sd"]
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when(F.size(v) != dim, F.lit("shape"))
        .when(unusable(vec_col), F.lit("nan"))
        .when(sd == 0, F.lit("constant"))
    )


def vector_rejects(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """P7 for vectors: (id, reason) of every unusable row. The reason is
    computed once per row (the filter is kept above it)."""
    reasons = computed_once(df.select(id_col, vector_reject_reason(vec_col, dim).alias("reason")))
    return reasons.where(F.col("reason").isNotNull())
