"""Array / vector column functions.

All are JVM-side higher-order functions. Per-row statistics (mean, std) are
handed to element lambdas through ``zip_with(v, array_repeat(stats, n))``:
a plain reference to a stats column inside a lambda would be inlined by
Catalyst's CollapseProject and recomputed for every element (O(d^2) per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double_array(v: str | Column) -> Column:
    """float32 arrays are accumulated in double."""
    return F.transform(_c(v), lambda x: x.cast("double"))


def array_sum(v: str | Column) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def array_mean(v: str | Column) -> Column:
    return F.try_divide(array_sum(v), F.size(_c(v)).cast("double"))


def map_with_row_value(v: str | Column, value: Column, fn) -> Column:
    """``transform(v, x -> fn(x, value))`` with ``value`` evaluated once per row."""
    c = _c(v)
    return F.zip_with(c, F.array_repeat(value, F.size(c)), fn)


def row_stats(v: str | Column) -> Column:
    """struct(mu, sd): per-row mean and population standard deviation (two-pass)."""
    c = _c(v)
    n = F.size(c).cast("double")
    mu = array_mean(c)
    sq = F.aggregate(
        map_with_row_value(c, mu, lambda x, m: (x.cast("double") - m) * (x.cast("double") - m)),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    return F.struct(mu.alias("mu"), F.sqrt(F.try_divide(sq, n)).alias("sd"))


def scale(v: str | Column, divisor: float = 255.0) -> Column:
    """x / divisor, in double."""
    return F.transform(_c(v), lambda x: x.cast("double") / F.lit(float(divisor)))


def standardize(v: str | Column, eps: float = 0.0) -> Column:
    """``(x - mean) / (std + eps)`` over the whole row.

    With ``eps == 0`` a constant row gives NULL elements (``try_divide``) where
    NumPy would give NaN; with ``eps > 0`` it gives zeros.
    """
    c = _c(v)
    stats = row_stats(c)
    if eps:
        return map_with_row_value(
            c, stats, lambda x, s: (x.cast("double") - s["mu"]) / (s["sd"] + F.lit(float(eps)))
        )
    return map_with_row_value(c, stats, lambda x, s: F.try_divide(x.cast("double") - s["mu"], s["sd"]))


def argmax(p: str | Column) -> Column:
    """0-based index of the first maximum (NumPy rule)."""
    c = _c(p)
    return (F.array_position(c, F.array_max(c)) - F.lit(1)).cast("int")


def confidence(p: str | Column) -> Column:
    """F16: the largest probability."""
    return F.array_max(_c(p))


def squared_distance(a: str | Column, b: str | Column) -> Column:
    """Sum of squared element differences of two equal-length arrays."""
    diffs = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


def softmax_neg(d: str | Column) -> Column:
    """``exp(-(d - min d)) / sum(exp(-(d - min d)))`` over an array of distances."""
    c = _c(d)
    shifted = map_with_row_value(c, F.array_min(c), lambda x, m: F.exp(-(x - m)))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return map_with_row_value(shifted, total, lambda x, t: x / t)
