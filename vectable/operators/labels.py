"""Label operators: distinct labels (U1, U2, A2), the dense label dictionary
(W2), encode / decode joins (J1, J2), split counts (A1), class distribution
with empty classes kept (A3), class presence (P9, J4).

The label dictionary is a dimension with one row per class, numbered in one
ordered window. Joins with it carry no hint: ``check_dimension`` reads a small
one once and makes it a local frame of known bytes, which Spark broadcasts
while it is under its threshold; a larger one stays a frame and is joined by
shuffle. The answers are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectable.functions.text import display_label, capitalize
from vectable.operators.common import small_or_plain

# Most values that ``column_values`` hands to the driver as a Python list.
MAX_CLASSES = 1_000_000


def distinct_labels(*frames: DataFrame, label_col: str = "label") -> DataFrame:
    """U1 + U2 + A2: union (by name) of the label column of each frame, distinct.

    Each input is projected to the label first, so scans read one column and
    the distinct is a partial/final hash aggregate (map-side combine).
    """
    if not frames:
        raise ValueError("need at least one frame")
    out = frames[0].select(label_col)
    for f in frames[1:]:
        out = out.unionByName(f.select(label_col))
    return out.distinct()


def label_dictionary(labels: DataFrame, label_col: str = "label", index_col: str = "label_index") -> DataFrame:
    """``enumerate(sorted(labels))`` as a frame (label, label_index int).

    Nulls are not labels. Ordering is Spark's binary string order, which is the
    code-point order Python's ``sorted`` uses.
    """
    d = labels.select(label_col).where(F.col(label_col).isNotNull()).distinct()
    w = Window.orderBy(F.col(label_col))
    return d.select(label_col, (F.row_number().over(w) - 1).cast("int").alias(index_col))


def check_dimension(dim: DataFrame) -> DataFrame:
    """The label dictionary as a local frame if it is small (see ``small_or_plain``)."""
    return small_or_plain(dim)


def encode_labels(
    df: DataFrame,
    dictionary: DataFrame,
    label_col: str = "label",
    index_col: str = "label_index",
    missing: int = -1,
    dict_label_col: str = "label",
    dict_index_col: str = "label_index",
) -> DataFrame:
    """Add ``index_col``; labels absent from the dictionary get ``missing``.

    A dictionary of a few classes is a local frame of known size, so the join
    is a broadcast hash join without a shuffle of ``df``.
    """
    dim = check_dimension(dictionary).select(F.col(dict_label_col).alias("__lbl"), F.col(dict_index_col).alias("__idx"))
    return (
        df.join(dim, df[label_col] == F.col("__lbl"), "left")
        .withColumn(index_col, F.coalesce(F.col("__idx"), F.lit(missing)).cast("int"))
        .drop("__lbl", "__idx")
    )


def decode_labels(
    df: DataFrame,
    dictionary: DataFrame,
    pairs: dict[str, str],
    dict_label_col: str = "label",
    dict_index_col: str = "label_index",
) -> DataFrame:
    """For each ``index column -> name column`` in ``pairs``, look the index up.

    An index missing from the dictionary is an error (as a dict subscript is):
    the query fails through ``raise_error`` inside the plan, with no extra job.
    """
    out = df
    dictionary = check_dimension(dictionary)
    for i, (src, dst) in enumerate(pairs.items()):
        k, v = f"__k{i}", f"__v{i}"
        dim = dictionary.select(F.col(dict_index_col).alias(k), F.col(dict_label_col).alias(v))
        out = out.join(dim, out[src] == F.col(k), "left")
        out = out.withColumn(
            dst,
            F.when(F.col(src).isNull(), F.lit(None).cast("string"))
            .when(F.col(k).isNull(), F.raise_error(F.concat(F.lit("unknown label index: "), F.col(src).cast("string"))))
            .otherwise(F.col(v)),
        ).drop(k, v)
    return out


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A1: rows per split, one job instead of one count per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def class_distribution(
    df: DataFrame,
    split_col: str,
    class_col: str,
    is_member: "F.Column",
    display: bool = True,
) -> DataFrame:
    """A3: members per (split, class) where every listed (split, class) is kept,
    including those with zero members.

    Rows are directory entries: a class that has entries but no member (say a
    folder holding only non-image files) shows 0. The count is a conditional
    sum inside one partial/final aggregate, so no completion join is needed.
    """
    out = df.groupBy(split_col, class_col).agg(
        F.sum(F.when(is_member, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("Images")
    )
    if display:
        out = out.select(
            capitalize(F.col(split_col)).alias("Dataset"),
            display_label(F.col(class_col)).alias("Class"),
            "Images",
        )
    return out


def class_distribution_wide(dist: DataFrame, splits: list[str]) -> DataFrame:
    """R2: one row per class, one column per split (grouped bars).

    The split values are passed explicitly so the pivot needs no extra job.
    """
    return dist.groupBy("Class").pivot("Dataset", splits).agg(F.sum("Images").cast("long")).na.fill(0, splits)


def _data_keys(data: DataFrame) -> DataFrame:
    # Distinct keys first: a partial aggregate leaves at most one row per class
    # per task, so the semi / anti join never shuffles the data rows.
    return data.distinct()


def classes_present(classes: DataFrame, data: DataFrame, on) -> DataFrame:
    """Classes that have data (left semi join). ``data`` holds only the
    key column(s)."""
    return classes.join(_data_keys(data), on, "left_semi")


def classes_missing(classes: DataFrame, data: DataFrame, on) -> DataFrame:
    """Classes without data (left anti join), for the 'folder missing' report."""
    return classes.join(_data_keys(data), on, "left_anti")


def dictionary_maps(dictionary: DataFrame, label_col: str = "label", index_col: str = "label_index"):
    """the dictionary as two map columns (label -> index, index -> label),
    each an uncorrelated scalar subquery over the class-sized dimension."""
    fwd = dictionary.select(F.map_from_entries(F.collect_list(F.struct(label_col, index_col)))).scalar()
    inv = dictionary.select(F.map_from_entries(F.collect_list(F.struct(index_col, label_col)))).scalar()
    return fwd, inv


def column_values(df: DataFrame, col: str, max_rows: int = MAX_CLASSES) -> list:
    """One column of a class-sized frame as a Python list, refusing
    frames above ``max_rows`` (never used on data-sized frames)."""
    rows = df.select(col).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{col}: more than {max_rows} values; not a class-sized frame")
    return [r[0] for r in rows]


def class_grid(classes: DataFrame, splits: list[str], class_col: str = "label", split_col: str = "split") -> DataFrame:
    """Every (split, class) pair of a known split list and the class
    dimension, for completing counts of classes that have no rows at all."""
    return classes.select(F.explode(F.array(*[F.lit(s) for s in splits])).alias(split_col), F.col(class_col))


def complete_counts(counts: DataFrame, grid: DataFrame, keys: list[str], count_col: str = "Images") -> DataFrame:
    """Left join counts onto the grid; missing pairs count 0."""
    return grid.join(counts, keys, "left").na.fill(0, [count_col])
