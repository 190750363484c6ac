"""Row caps, top-k per class, paging and deterministic mini-batches
(L1-L3, L7-L9, W1).

``limit`` without an order is not deterministic, so every cap here has an
explicit order: ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject
(a bounded top-n per partition, then a merge of at most n rows per partition).

Mini-batch numbering (L7) needs a global row number in a seeded shuffled
order. A window over the whole frame would pull every row into one task, so
the order key is an md5 hash: its leading hex digits cut the key space into
``16**prefix_len`` equal ranges, as many as the row count asks for
(``RANGE_ROWS`` rows a range). Rows are numbered inside each range (a window
partitioned by the range), and each range's offset comes from a prefix sum
over the per-range counts, a frame with a row for each range. The hash of a
unique row id spreads even a hot class over all ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a range of ``with_row_number`` should hold.
RANGE_ROWS = 500_000


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def ordered_cap(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """L1 / L2: the first ``n`` rows in ``order``."""
    return df.orderBy(*_cols(order)).limit(n)


def first_row(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """L3: the first row in ``order`` (as a one-row frame)."""
    return ordered_cap(df, 1, order)


def page(df: DataFrame, page_no: int, order: Sequence[str | Column], page_size: int = 10) -> DataFrame:
    """Rows ``page_no*page_size .. +page_size`` in ``order`` (0-based pages).

    The rows before the page are sorted out in one task, so this suits the
    first pages; ``page_after`` goes on from a page's last key at any depth."""
    if page_no < 0 or page_size <= 0:
        raise ValueError("page_no must be >= 0 and page_size > 0")
    return df.orderBy(*_cols(order)).offset(page_no * page_size).limit(page_size)


def page_after(df: DataFrame, last: object | None, key: str, page_size: int = 10) -> DataFrame:
    """L9 by key: the first ``page_size`` rows whose unique ``key`` is above
    ``last``, the last key of the page before (None: the first page). A pushed
    filter and a bounded top-n, the same cost for every page."""
    rows = df if last is None else df.where(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(page_size)


def first_n_per_group(df: DataFrame, group_col: str, order: Sequence[str | Column], n: int = 5, rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group in ``order``.

    ``row_number() <= n`` is planned with a WindowGroupLimit on both sides of
    the shuffle, so a large group ships at most n rows per map task.
    """
    w = Window.partitionBy(group_col).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def shuffle_key(id_col: str | Column, seed: str | int) -> Column:
    """Seeded pseudo-random order key: md5 of the id text (none for a NULL id)
    followed by the seed."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.coalesce(c.cast("string"), F.lit("")), F.lit(str(seed))))


def with_row_number(
    df: DataFrame,
    key: Column,
    tie: str | Column,
    out_col: str = "row_idx",
    prefix_len: int | None = None,
) -> DataFrame:
    """0-based global position of each row in (``key``, ``tie``) order, where
    ``key`` is a lower-case hex string (e.g. an md5).

    Distributed: window partitions are the ``16**prefix_len`` key ranges
    (default: one count of the rows decides). No row is lost: a NULL key sorts
    as an empty one.
    """
    tie_c = F.col(tie) if isinstance(tie, str) else tie
    if prefix_len is None:
        prefix_len = max(1, math.ceil(math.log(max(1, df.count() / RANGE_ROWS), 16)))
    keyed = df.withColumn("__key", F.coalesce(key, F.lit(""))).withColumn("__range", F.substr(F.col("__key"), F.lit(1), F.lit(prefix_len)))
    counts = keyed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # A row for each range: one small window, then a join that needs no hint.
    offsets = counts.select(
        "__range",
        (F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).select("__range", F.coalesce("__off", F.lit(0)).cast("long").alias("__off"))
    w = Window.partitionBy("__range").orderBy(F.col("__key"), tie_c)
    return (
        keyed.join(offsets, "__range")
        .withColumn(out_col, (F.col("__off") + F.row_number().over(w) - F.lit(1)).cast("long"))
        .drop("__key", "__range", "__off")
    )


def mini_batches(
    df: DataFrame,
    id_col: str,
    seed: str | int = 42,
    batch_size: int = 32,
    batch_col: str = "batch_id",
    pos_col: str = "row_idx",
    prefix_len: int | None = None,
) -> DataFrame:
    """Seeded shuffle then batches of ``batch_size`` (the last may be short).
    ``id_col`` should be unique; it is also the tie-breaker (a NULL id first).
    Every row gets a batch."""
    out = with_row_number(df, shuffle_key(id_col, seed), id_col, pos_col, prefix_len)
    return out.withColumn(batch_col, F.floor(F.col(pos_col) / F.lit(batch_size)).cast("long"))


def batch_summary(batched: DataFrame, label_col: str, batch_col: str = "batch_id", pos_col: str = "row_idx", head: int = 5) -> DataFrame:
    """L8 + A18: per batch its size and the first ``head`` labels, in batch order.

    A batch holds at most ``batch_size`` rows, so collecting within a batch is
    bounded.
    """
    first = F.slice(F.array_sort(F.collect_list(F.struct(F.col(pos_col), F.col(label_col).alias("l")))), 1, head)
    return batched.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array_join(F.transform(first, lambda s: s["l"].cast("string")), ",").alias("first_labels"),
    )
