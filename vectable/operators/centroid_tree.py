"""K4, J5 for very many classes: nearest centroids by a tree of leaves.

``vectors.nearest_centroid`` compares every row with every centroid. Here the
centroids are dealt once to the nearest of a bounded number of pivots, and those
of a pivot, in the order of their distance to it, to leaves of ``LEAF`` rows,
written as a table with a folder for each leaf. The driver sees the pivots
(``PIVOT_BYTES`` at most) and three numbers of each leaf, no centroids.

A row is at least ``|d(row, pivot) - d(centroid, pivot)|`` from a centroid
(triangle inequality), so each leaf has a least distance to each row by its
nearest and farthest centroid. A task visits leaves in the order of that
distance, reads a leaf from the table when the first row needs it (keeping
``CACHE_BYTES`` of them), compares the rows whose best is farther than the
leaf's least distance, and stops where no row is. Results are exact; the number
of comparisons of a row is told.

The folder of the table must be one that Arrow opens from the executors (local,
HDFS, S3, GCS).
"""

from __future__ import annotations

import math
import sys
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from vectable.operators.quality import unusable
from vectable.operators.vectors import vector_rows
from vectable.session import scratch_path
from vectable.sources.tree import _opened

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF, PIVOTS, PIVOT_BYTES, CACHE_BYTES = 256, 1024, 8 << 20, 64 << 20
#: Distances in 64-bit numbers are off by less than this share of what they are made of.
SLACK = 1e-9


class Tree:
    """Pivots, and of each leaf its pivot and the least and largest distance to it."""

    def __init__(self, path: str, label: StructField, pivots: np.ndarray, pivot_of: np.ndarray, near: np.ndarray, far: np.ndarray, n: int):
        self.path, self.label, self.pivots, self.pivot_of, self.near, self.far, self.n = path, label, pivots, pivot_of, near, far, n


def _distances(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (m * m).sum(axis=1)[None, :] - 2.0 * (x @ m.T)
    return np.maximum(d, 0.0)


def build_tree(centroids: DataFrame, label_col: str = "label", mean_col: str = "mean") -> Tree:
    """A tree over centroids of one length (rows without a usable mean or a
    label are left out)."""
    spark = centroids.sparkSession
    rows = centroids.where(F.col(label_col).isNotNull() & ~unusable(mean_col)).select(F.col(label_col).alias("label"), F.col(mean_col).cast("array<double>").alias("m"))
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(F.size("m")), F.max(F.size("m"))).first()
    if not n:
        raise ValueError("no centroids")
    if low != high or not low:
        raise ValueError(f"centroids of unequal lengths: {low} to {high}")
    d = int(low)
    many = int(max(1, min(PIVOTS, PIVOT_BYTES // (8 * d), math.ceil(math.sqrt(n)))))
    picked = rows.orderBy(F.xxhash64("label", F.lit("pivot")), "label").limit(many).collect()  # PIVOT_BYTES at most
    pivots = np.array([r["m"] for r in picked])
    label = rows.schema["label"]
    with_pivot = StructType([label, StructField("m", ArrayType(DoubleType())), StructField("pivot", LongType()), StructField("away", DoubleType())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = vector_rows(batch.column(1), d)
            dist = _distances(x, pivots)
            own = dist.argmin(axis=1)
            away = np.sqrt(dist[np.arange(len(x)), own])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(own), pa.array(away)], ["label", "m", "pivot", "away"])

    # Leaves: the centroids of a pivot by their distance to it. A range holds several pivots' or part of one's.
    ranges = max(1, -(-n // LEAF))
    dealt = rows.mapInArrow(assigned, with_pivot).repartitionByRange(ranges, "pivot", "away", "label").sortWithinPartitions("pivot", "away", "label")
    out = StructType([*with_pivot.fields, StructField("leaf", LongType())])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        leaf, last, size = (TaskContext.get().partitionId() << 20) - 1, None, 0
        for batch in batches:
            numbers = []
            for p in batch.column(2).to_pylist():
                if p != last or size == LEAF:
                    leaf, last, size = leaf + 1, p, 0
                numbers.append(leaf)
                size += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "leaf"])

    path = scratch_path(spark, "centroid-tree")
    dealt.mapInArrow(leaves, out).write.partitionBy("leaf").parquet(path)
    table = spark.read.schema(out).parquet(path)
    told = table.groupBy("leaf", "pivot").agg(F.min("away").alias("near"), F.max("away").alias("far")).orderBy("leaf").collect()  # three numbers a leaf
    tree = Tree(path, label, pivots, np.array([t["pivot"] for t in told]), np.array([t["near"] for t in told]), np.array([t["far"] for t in told]), n)
    tree.names = [t["leaf"] for t in told]
    return tree


class _Leaves:
    """Leaves read by a task, the last used ones kept."""

    def __init__(self, tree: Tree):
        self.tree, self.held, self.size = tree, OrderedDict(), 0

    def __getitem__(self, i: int) -> tuple[list, np.ndarray]:
        if i in self.held:
            self.held.move_to_end(i)
            return self.held[i]
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, base = _opened(self.tree.path)
        files = [f.path for f in system.get_file_info(fs.FileSelector(f"{base}/leaf={self.tree.names[i]}")) if f.path.endswith(".parquet")]
        tables = [pq.read_table(system.open_input_file(f), columns=["label", "m"], partitioning=None) for f in sorted(files)]
        both = pa.concat_tables(tables).combine_chunks()
        m = both.column("m").combine_chunks().flatten().to_numpy().reshape(both.num_rows, -1)
        self.held[i] = (both.column("label").to_pylist(), m)
        self.size += m.nbytes
        while self.size > CACHE_BYTES and len(self.held) > 1:
            self.size -= self.held.popitem(last=False)[1][1].nbytes
        return self.held[i]


def _searched(x: np.ndarray, tree: Tree, leaves: _Leaves) -> tuple[list, np.ndarray, np.ndarray]:
    """Label, squared distance and comparisons of each row."""
    n = len(x)
    to_pivot = np.sqrt(_distances(x, tree.pivots))
    size = np.sqrt((x * x).sum(axis=1)) + np.sqrt((tree.pivots**2).sum(axis=1)).max() + tree.far.max()
    slack = SLACK * size + 1e-7 * size  # square roots of differences lose half the digits
    away = to_pivot[:, tree.pivot_of]
    least = np.maximum(np.maximum(away - tree.far[None, :], tree.near[None, :] - away), 0.0) - slack[:, None]
    best, names, compared = np.full(n, np.inf), [None] * n, np.full(n, len(tree.pivots), np.int64)
    # Each row's nearest leaf first, so that bounds are tight early; then the others by their least distance to any row.
    first = least.argmin(axis=1)
    order = list(dict.fromkeys([*np.unique(first).tolist(), *np.argsort(least.min(axis=0), kind="stable").tolist()]))
    seen = np.zeros((n, len(tree.far)), dtype=bool)

    def visit(i: int, at: np.ndarray) -> None:
        if not len(at):
            return
        labels, m = leaves[i]
        dist = _distances(x[at], m)
        low = dist.min(axis=1)
        compared[at] += len(m)
        seen[at, i] = True
        for r, row, d in zip(at, dist, low, strict=True):
            if d <= best[r]:
                name = min(labels[k] for k in np.flatnonzero(row == d))
                if d < best[r] or names[r] is None or name < names[r]:
                    best[r], names[r] = d, name

    for i in np.unique(first):
        visit(int(i), np.flatnonzero(first == i))
    for i in order:
        visit(i, np.flatnonzero(~seen[:, i] & (least[:, i] <= np.sqrt(best))))
    return names, best, compared


def nearest_in_tree(df: DataFrame, tree: Tree, vec_col: str, pred_col: str = "prediction", distance_col: str = "distance", compared_col: str = "n_compared") -> DataFrame:
    """The rows (without the vector) with the label of the nearest centroid, the
    squared distance to it (ties: the smaller label) and how many centroids and
    pivots the row was compared with; NULLs where the vector cannot be used."""
    shared = df.sparkSession.sparkContext.broadcast(tree)
    kept = [f for f in df.schema.fields if f.name not in (vec_col, pred_col, distance_col, compared_col)]
    new = [StructField(pred_col, tree.label.dataType), StructField(distance_col, DoubleType()), StructField(compared_col, LongType())]
    types = [to_arrow_schema(StructType(new)).field(i).type for i in range(3)]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves = _Leaves(shared.value)
        d = leaves.tree.pivots.shape[1]
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                x, at = vector_rows(batch.column(vec_col), d)
                out: list[list] = [[None] * batch.num_rows for _ in new]
                if len(at):
                    for column, values in zip(out, _searched(x, leaves.tree, leaves), strict=True):
                        for r, v in zip(at, values, strict=True):
                            column[r] = v
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(pa.array(v, t) for v, t in zip(out, types, strict=True))], [f.name for f in [*kept, *new]])

    return df.mapInArrow(fn, StructType([*kept, *new]))
