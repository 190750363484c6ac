"""Vectors scaled to integers, in packed blocks: what operators 12 and 13 share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import expand, squeeze, stored

ROWS = 4096
LIMIT = 2**31 - 1


def int_blocks(rows: DataFrame, keep: Sequence[str], vec: str, scale: int) -> DataFrame:
    """Blocks ``(block, n, dim, biggest, <keep> arrays, data, squares)``, written
    once: the components ``floor(scale * x)`` of up to ``ROWS`` vectors as
    compressed 32-bit numbers, row by row, the largest size of a component, and
    the sum of squares of each dimension. Vectors that are null or empty or hold
    a null or non-finite component are left out."""
    kinds = dict(rows.dtypes)
    schema = "block long, n int, dim int, biggest double, " + ", ".join(f"`{c}` array<{kinds[c]}>" for c in keep) + ", data binary, squares array<double>"

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = batch.column(len(keep))
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            rows_at = np.flatnonzero(size > 0)
            if not len(rows_at):
                continue
            dim = int(size[rows_at[0]])
            if (size[rows_at] != dim).any():
                raise ValueError(f"vectors of unequal lengths: {size[rows_at].min()} to {size[rows_at].max()}")
            x = lists.take(pa.array(rows_at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
            fine = np.isfinite(x).all(axis=1)
            rows_at = rows_at[fine]
            with np.errstate(over="ignore"):
                x = np.floor(x[fine] * scale)
            for i in range(0, len(x), ROWS):
                part, ids = x[i : i + ROWS], pa.array(rows_at[i : i + ROWS])
                columns = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), batch.column(c).take(ids)) for c in range(len(keep))]
                data = squeeze(np.clip(part, -LIMIT, LIMIT).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), pa.array([len(part)], pa.int32()), pa.array([dim], pa.int32()), pa.array([float(np.abs(part).max())]), *columns, pa.array([data], pa.binary()), pa.array([(part**2).sum(axis=0)], pa.list_(pa.float64()))],
                    ["block", "n", "dim", "biggest", *keep, "data", "squares"],
                )
                at += 1

    return stored(rows.select(*keep, vec).mapInArrow(fn, schema), "int_blocks")


def shape(blocks: DataFrame) -> tuple[int, int, float]:
    """Rows, the one length of the vectors and the largest size of a component.
    Vectors of unequal lengths and components beyond 32 bits raise an error."""
    n, low, high, biggest = blocks.agg(F.sum("n"), F.min("dim"), F.max("dim"), F.max("biggest")).first()
    if low != high:
        raise ValueError(f"vectors of unequal lengths: {low} to {high}")
    if biggest is not None and biggest > LIMIT:
        raise ValueError(f"scaled components of up to {biggest} do not fit 32 bits")
    return int(n or 0), int(low or 0), float(biggest or 0)


def components_of(data: bytes, dim: int) -> np.ndarray:
    return expand(data, np.int32).reshape(-1, dim)
