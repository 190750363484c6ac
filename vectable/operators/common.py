"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame) -> DataFrame:
    """Keep expensive columns from being recomputed by pushed-down filters.

    Catalyst pushes a filter on a projected alias below the projection by
    substituting the alias's expression, so a later ``isnotnull(prediction)``
    (often inferred from a join) evaluates a costly scoring expression a
    second time. Passing the row through a one-element ``inline`` makes those
    columns generator output: filters on them stay above, and the work runs
    once per row.
    """
    cols = df.columns
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in cols]))))


class DimensionTooLarge(ValueError):
    """A frame meant to be broadcast exceeds its row bound."""


def bounded_dimension(df: DataFrame, max_rows: int, what: str = "dimension") -> DataFrame:
    """Prove a small frame's size before it is broadcast.

    Reads at most ``max_rows + 1`` rows (one small job), fails above the
    bound, and returns the rows as a local relation: its exact size is known
    to the planner, and joins against it never recompute the original plan.
    Frames already returned by this function pass through unchanged.
    """
    if getattr(df, "_vectable_rows", None) is not None and df._vectable_rows <= max_rows:
        return df
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise DimensionTooLarge(f"{what} has more than {max_rows} rows; refusing to broadcast it")
    out = df.sparkSession.createDataFrame(rows, df.schema)
    out._vectable_rows = len(rows)
    return out


#: Rows and bytes that ``small_or_plain`` may make a local frame of.
SMALL_ROWS, SMALL_BYTES = 20_000, 8 * 1024 * 1024


def small_or_plain(df: DataFrame) -> DataFrame:
    """A frame of at most ``SMALL_ROWS`` and ``SMALL_BYTES`` as a local relation,
    whose exact size the planner knows; a larger one as it is, for an ordinary
    join. One bounded read; no size is refused, and results are the same."""
    if getattr(df, "_vectable_checked", False):
        return df
    rows = df.limit(SMALL_ROWS + 1).toArrow()
    small = rows.num_rows <= SMALL_ROWS and rows.nbytes <= SMALL_BYTES
    out = df.sparkSession.createDataFrame(rows, df.schema) if small else df
    out._vectable_checked = True
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once and cut its lineage: write it as Parquet to a fresh
    folder under the shared checkpoint folder (``spark.checkpoint.dir``) and
    read it back. One job (``Dataset.checkpoint`` computes the plan twice
    unless cached); the copy survives executor loss. Frames already returned
    by this function pass through unchanged.
    """
    if getattr(df, "_vectable_materialized", False):
        return df
    from vectable.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._vectable_materialized = True
    return out
