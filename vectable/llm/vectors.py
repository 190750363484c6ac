"""Vectors as rows of matrices: what the two embedding operators share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix(column: pd.Series, dim: int) -> np.ndarray:
    """Rows of equal length in double precision."""
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), dim)


def usable(vec: str, dim: Column | int | None = None) -> Column:
    """Neither null nor empty nor zero, every component finite (of length ``dim``)."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = F.col(vec).isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)
    return F.coalesce(out if dim is None else out & (F.size(vec) == dim), F.lit(False))


def dimension(vectors: DataFrame, vec: str) -> int:
    """The one length of the usable vectors; unequal lengths can't be compared."""
    low, high = vectors.where(usable(vec)).agg(F.min(F.size(vec)), F.max(F.size(vec))).first()
    if low != high:
        raise ValueError(f"vectors of unequal lengths: {low} to {high}")
    return int(low or 0)


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))
