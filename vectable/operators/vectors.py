"""Vector operators: standardise (F13, F14), class mean vectors (A4), shape
checks (F17), and the nearest-class-centroid classifier (K4, J5, K5).

Class means are sums made inside Arrow batches, so a class holding a third of
all rows is combined inside each map task before the shuffle, and the
shuffled state is one d-vector per (task, class), whatever the number of
classes.

Scoring compares every row with every class centroid, without a shuffle: the
centroids are cut into blocks of at most ``block_bytes``, each block is one
broadcast variable, and one narrow step over the rows goes from block to block
and keeps the running minimum. A task has one Python worker, whatever the
number of blocks, and the answers do not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from vectable.functions import arrays as A
from vectable.operators.common import computed_once, materialize
from vectable.operators.quality import unusable

BLOCK_BYTES = 8 * 1024 * 1024  # of centroids in one broadcast block


def vector_dims(df: DataFrame, vec_col: str) -> DataFrame:
    """F17 helper: distinct row lengths (a small frame: one row per length)."""
    return df.groupBy(F.size(vec_col).alias("dim")).agg(F.count(F.lit(1)).alias("n_rows"))


def check_uniform_dim(df: DataFrame, vec_col: str) -> int:
    """all rows must have one length (``np.stack`` rule); returns it."""
    dims = vector_dims(df, vec_col).where(F.col("dim") >= 0).collect()
    if len(dims) != 1:
        raise ValueError(f"rows of {vec_col} have unequal lengths: {sorted(r['dim'] for r in dims)}")
    return int(dims[0]["dim"])


#: Bytes of sums that a task holds before it passes them on.
SUM_BYTES = 64 << 20


def _added(s: np.ndarray, e: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A running sum and its rounding errors (Neumaier) after one more term."""
    t = s + y
    return t, e + np.where(np.abs(s) >= np.abs(y), (s - t) + y, (y - t) + s)


def class_sums(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """A4, first half: ``label_col, sum, n_rows`` for each class of each task,
    summed inside Arrow batches. Rounding errors between batches are carried
    along (Neumaier), so a class's sum doesn't depend on how many batches it
    comes in. Sums go on when they take ``SUM_BYTES``, so memory is bounded for
    any number of classes."""
    label = df.schema[label_col]
    out = StructType([label, StructField("sum", ArrayType(DoubleType())), StructField("n_rows", LongType())])
    types = [to_arrow_schema(out).field(i).type for i in range(3)]

    def rows(held: dict) -> pa.RecordBatch:
        sums = [s + e for s, e, _ in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), types[0]), pa.array(sums, types[1]), pa.array([n for _, _, n in held.values()], types[2])], [label_col, "sum", "n_rows"])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            lists = batch.column(1)
            for d in pc.unique(pc.list_value_length(lists)).to_pylist():
                if not d:
                    continue
                x, at = vector_rows(lists, d)
                if not len(at):
                    continue
                labels = batch.column(0).take(pa.array(at)).dictionary_encode(null_encoding="encode")
                codes, names = labels.indices.to_numpy(zero_copy_only=False), labels.dictionary.to_pylist()
                order = np.argsort(codes, kind="stable")
                codes, x = codes[order], x[order]
                start = np.flatnonzero(np.diff(codes, prepend=-1))
                many = np.diff(np.append(start, len(codes)))
                for c, y, n in zip(codes[start], np.add.reduceat(x, start, axis=0), many, strict=True):
                    s, e, m = held.get(names[c], (np.zeros(d), np.zeros(d), 0))
                    if len(s) != d:
                        raise ValueError(f"vectors of unequal lengths: {len(s)} and {d}")
                    held[names[c]] = (*_added(s, e, y), m + int(n))
                if len(held) * d * 16 > SUM_BYTES:
                    yield rows(held)
                    held = {}
        if held:
            yield rows(held)

    return df.select(label_col, vec_col).mapInArrow(fn, out)


def class_means(df: DataFrame, label_col: str, vec_col: str, out_col: str = "mean") -> DataFrame:
    """A4: element-wise mean vector per class, as array<double>, plus the count
    of rows with a usable vector (rows without one, or with a NULL or
    non-finite element such as a standardised constant row, do not contribute;
    vectors of unequal length raise, as stacking them would).

    Vectors are summed where they are (``class_sums``): what is shuffled is a
    row for each task and class, and a task then adds up one class after the
    other, whatever the number of classes."""
    parts = class_sums(df, label_col, vec_col)
    out = StructType([df.schema[label_col], StructField(out_col, ArrayType(DoubleType())), StructField("n_rows", LongType())])
    types = [to_arrow_schema(out).field(i).type for i in range(3)]

    def mean(name, s: np.ndarray, e: np.ndarray, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name], types[0]), pa.array([(s + e) / n], types[1]), pa.array([n], types[2])], out.names)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # one class at a time: its rows follow each other
        for batch in batches:
            names, many = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for name, sums, n in zip(names, batch.column(1), many, strict=True):
                y = sums.values.to_numpy()
                if held is not None and held[0] == name:
                    if len(y) != len(held[1]):
                        raise ValueError(f"vectors of unequal lengths: {len(held[1])} and {len(y)}")
                    held = (name, *_added(held[1], held[2], y), held[3] + n)
                    continue
                if held is not None:
                    yield mean(*held)
                held = (name, y, np.zeros(len(y)), n)
        if held is not None:
            yield mean(*held)

    return parts.repartition(label_col).sortWithinPartitions(label_col).mapInArrow(merged, out)


def class_means_truncated(df: DataFrame, label_col: str, vec_col: str, out_col: str = "mean") -> DataFrame:
    """A4 as in the mean-image view: float mean truncated to integer.

    Inputs are pixel values >= 0, where a cast to int truncates like
    ``astype(uint8)``.
    """
    m = class_means(df, label_col, vec_col, out_col)
    return m.withColumn(out_col, F.transform(out_col, lambda x: x.cast("int")))


def vector_rows(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Of an Arrow list column: the usable rows (length ``d``, every element
    finite) as one matrix, and which rows these are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ok = pc.fill_null(pc.equal(pc.list_value_length(column), d), False)
    x = column.filter(ok).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)
    at = np.flatnonzero(ok.to_numpy(zero_copy_only=False))
    finite = np.isfinite(x).all(axis=1)  # a NULL element is NaN here
    return x[finite], at[finite]


def _standardized(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows standardised; constant ones, for which that is undefined, left out."""
    sd = x.std(axis=1, keepdims=True)
    keep = sd[:, 0] != 0
    return ((x - x.mean(axis=1, keepdims=True))[keep] / sd[keep]), at[keep]


def _score_arrow(df: DataFrame, vec_col: str, cents: DataFrame, d: int, block_bytes: int, standardize: bool, all_distances: bool) -> DataFrame:
    """``__cls`` and ``__dist``, without the vector: one Arrow step that meets the
    blocks of centroids in turn. A batch's distances to a block are one matrix product."""
    spark = df.sparkSession
    per_block = max(1, block_bytes // (d * 8 + 16))
    blocks: list[tuple[list, list]] = []
    for r in cents.orderBy("label").toLocalIterator():  # class-sized
        if not blocks or len(blocks[-1][0]) == per_block:
            blocks.append(([], []))
        blocks[-1][0].append(r["label"])
        blocks[-1][1].append(r["c"])
    shared = [spark.sparkContext.broadcast((names, np.array(rows, dtype=np.float64).reshape(-1, d))) for names, rows in blocks]
    kinds = [cents.schema["label"].dataType, DoubleType()]
    state = [StructField(n, ArrayType(k) if all_distances else k) for n, k in zip(("__cls", "__dist"), kinds, strict=True)]
    kept = [f for f in df.schema.fields if f.name != vec_col]
    arrow = to_arrow_schema(StructType(state))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = vector_rows(batch.column(vec_col), d)
            if standardize:
                x, at = _standardized(x, at)
            size = (x * x).sum(axis=1)[:, None]
            cls, least = [None] * batch.num_rows, [None] * batch.num_rows
            for i, block in enumerate(shared):
                names, m = block.value
                dist = np.maximum(size + (m * m).sum(axis=1)[None, :] - 2.0 * (x @ m.T), 0.0)
                if all_distances:
                    cls = [(c or []) + names for c in cls]
                    for j, r in enumerate(at):
                        least[r] = (least[r] or []) + dist[j].tolist()
                    continue
                k = dist.argmin(axis=1)  # the first of equal distances: the smaller class
                low = dist[np.arange(len(at)), k]
                if not i:
                    best, name = low, [names[c] for c in k]
                    continue
                for j in np.flatnonzero(low < best):
                    best[j], name[j] = low[j], names[k[j]]
            if not all_distances:
                for j, r in enumerate(at):
                    cls[r], least[r] = name[j], float(best[j])
            cols = [*(batch.column(f.name) for f in kept), pa.array(cls, arrow[0].type), pa.array(least, arrow[1].type)]
            yield pa.RecordBatch.from_arrays(cols, names=[*(f.name for f in kept), "__cls", "__dist"])

    return df.mapInArrow(fn, StructType([*kept, *state]))


def _score_jvm(df: DataFrame, vec_col: str, cents: DataFrame, d: int, block_bytes: int, standardize: bool, all_distances: bool) -> DataFrame:
    """The same columns with JVM higher-order functions. The centroid list is a
    scalar subquery, attached as a column first (subqueries may not sit inside
    higher-order functions)."""
    arr = cents.select(F.array_sort(F.collect_list(F.struct("label", "c"))).alias("cs")).scalar()
    v = A.standardize("__v") if standardize else A.as_double_array("__v")
    kept = [c for c in df.columns if c != vec_col]
    rows = computed_once(df.select(*kept, F.when(~unusable(vec_col, d), F.col(vec_col)).alias("__v")))
    dists = F.transform("__cents", lambda c: A.squared_distance(v, c["c"]))
    out = (
        rows.withColumn("__cents", arr)
        .withColumn("__cls", F.transform("__cents", lambda c: c["label"]))
        .withColumn("__dist", F.when(F.col("__v").isNotNull() & ~F.exists(v, lambda x: x.isNull()), dists))
    )
    out = computed_once(out.select(*kept, "__cls", "__dist"))
    if all_distances:
        return out
    best = F.array_min("__dist")
    at = F.array_position("__dist", best).cast("int")
    return out.select(*kept, F.when(F.col("__dist").isNotNull(), F.element_at("__cls", at)).alias("__cls"), best.alias("__dist"))


def nearest_centroid(
    df: DataFrame,
    centroids: DataFrame,
    vec_col: str,
    label_col: str = "label",
    centroid_col: str = "mean",
    pred_col: str = "prediction",
    dist_col: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    with_distances: bool = False,
    engine: str = "arrow",
    standardize_input: bool = False,
) -> DataFrame:
    """K4 + J5: predicted class = centroid with the least squared distance; ties
    go to the smaller class label. Rows whose vector cannot be used (NULL, of
    another length, a NULL or non-finite element) get NULL; every row stays,
    whatever its keys. The vector itself is not returned.

    ``with_distances`` also returns ``classes`` (labels, ascending) and
    ``distances`` (aligned), used by ``class_probabilities``.

    ``engine="arrow"`` scores Arrow batches with NumPy (about 10x faster than
    ``engine="jvm"``, whose higher-order functions are interpreted per element
    outside whole-stage codegen); both give the same predictions.

    ``standardize_input`` standardises each vector (F13) inside the scoring
    pass, so centroids of standardised vectors can score raw vectors without
    a second standardisation pass over the data. Constant rows get NULL.
    """
    # The centroid table is class-sized: compute it once, cut its lineage in the
    # shared checkpoint folder, and read it a block at a time.
    cents = materialize(centroids, "centroids").select(F.col(label_col).alias("label"), F.col(centroid_col).alias("c"))
    k, d = cents.select(F.count(F.lit(1)), F.max(F.size("c"))).first()
    k, d = int(k or 0), int(d or 0)
    if k == 0:
        raise ValueError("no class centroids")
    score = {"arrow": _score_arrow, "jvm": _score_jvm}[engine]
    out = score(df, vec_col, cents, d, block_bytes, standardize_input, with_distances)
    if with_distances:
        best = F.array_min("__dist")
        at = F.array_position("__dist", best).cast("int")
        out = out.withColumn(pred_col, F.when(F.col("__dist").isNotNull(), F.element_at("__cls", at)))
        out = out.withColumn(dist_col, best) if dist_col else out
        return out.withColumnRenamed("__cls", "classes").withColumnRenamed("__dist", "distances")
    out = out.withColumnRenamed("__cls", pred_col)
    return out.withColumnRenamed("__dist", dist_col) if dist_col else out.drop("__dist")


def class_probabilities(scored: DataFrame, dist_col: str = "distances", out_col: str = "probability") -> DataFrame:
    """K5: softmax over negative distances, aligned with ``classes``:
    ``p_c = exp(-(d_c - min d)) / sum_j exp(-(d_j - min d))``."""
    return scored.withColumn(out_col, A.softmax_neg(dist_col))
