"""Dense numbering and pages of any number, without a global window.

Rows are dealt by key ranges, sorted inside each, and written as a table with a
folder for each range; every row carries its place in its range. The sizes of
the ranges give each one's offset, so a row's number in the whole order is an
addition, and a page reads the one or two folders that hold it.

Ranges hold about ``RANGE_ROWS`` rows each. The whole row breaks ties between
equal keys, so a key that a third of all rows share is dealt over many ranges;
only rows that are equal in every column stay together.

Spark finds the bounds of the ranges from a sample of keys on the driver, so
ranges smaller than ``RANGE_ROWS`` are made only as long as they are ``RANGES``
at most and their keys take ``SAMPLE_BYTES``; a larger table gets wider ranges.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from vectable.session import scratch_path

RANGE_ROWS = 500_000
#: Most ranges of under RANGE_ROWS rows, most bytes of keys that Spark samples for them, and keys it takes for each.
RANGES, SAMPLE_BYTES, SAMPLED = 256, 64 << 20, 300
RANGE, PLACE = "__range", "__place"


class Ranked:
    """A table in key order: its ranges and how many rows come before each."""

    def __init__(self, table: DataFrame, columns: Sequence[str], starts: list[int], n: int):
        self.table, self.columns, self.starts, self.n = table, list(columns), starts, n

    def numbered(self, out_col: str = "row_idx") -> DataFrame:
        """All rows with their number, from 0, in key order."""
        spark = self.table.sparkSession
        offsets = spark.createDataFrame(list(enumerate(self.starts)), f"{RANGE} int, __start long")  # a row for each range
        number = (F.col("__start") + F.col(PLACE)).alias(out_col)
        return self.table.join(offsets, RANGE).select(*self.columns, number)

    def slice(self, first: int, rows: int) -> DataFrame:
        """Rows number ``first`` and on, ``rows`` of them, in order."""
        last = min(first + rows, self.n)
        if first >= last or first < 0:
            return self.table.select(*self.columns).limit(0)
        a, b = bisect_right(self.starts, first) - 1, bisect_right(self.starts, last - 1) - 1
        low = first - self.starts[a]
        part = self.table.where(F.col(RANGE).between(a, b) & ((F.col(RANGE) > a) | (F.col(PLACE) >= low)))
        part = part.where((F.col(RANGE) < b) | (F.col(PLACE) < last - self.starts[b]))
        return part.orderBy(RANGE, PLACE).limit(rows).select(*self.columns)

    def page(self, number: int, page_size: int = 10) -> DataFrame:
        """Page ``number`` (from 0)."""
        return self.slice(number * page_size, page_size)


def range_count(rows: int, key_bytes: int, range_rows: int | None = None) -> int:
    """Ranges of about ``range_rows`` rows for a table whose keys take
    ``key_bytes``; of smaller ones than ``RANGE_ROWS`` as many as the driver
    can sample."""
    sampled = SAMPLED * max(1, -(-key_bytes // max(1, rows)))
    few = max(1, min(RANGES, SAMPLE_BYTES // sampled))
    return max(1, -(-rows // RANGE_ROWS), min(-(-rows // (range_rows or RANGE_ROWS)), few))


def ranked(df: DataFrame, order: Sequence[str], range_rows: int | None = None) -> Ranked:
    """``df`` in the order of some columns (nulls first), ready for numbers and
    pages. The frame is computed once for its count and once for the table."""
    spark = df.sparkSession
    wide = [c for c in order if isinstance(df.schema[c].dataType, StringType | BinaryType)]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wide), F.lit(8 * len(order)))
    n, key_bytes = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    ranges = range_count(n, key_bytes or 0, range_rows)
    rest = [c for c in df.columns if c not in order]
    keys = [*order, F.xxhash64(*rest)] if rest else [*order]
    schema = StructType([*df.schema.fields, StructField(RANGE, IntegerType()), StructField(PLACE, LongType())])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * k, pa.int32()), pa.array(range(at, at + k), pa.int64())], [*batch.schema.names, RANGE, PLACE])
            at += k

    path = scratch_path(spark, "ranked")
    rows = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).mapInArrow(fn, schema)
    rows.write.partitionBy(RANGE).parquet(path)
    written = StructType([*df.schema.fields, schema[PLACE], schema[RANGE]])
    table = spark.read.schema(written).parquet(path)
    sizes = {r[RANGE]: r["n"] for r in table.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each range
    many = [sizes.get(i, 0) for i in range(max(sizes, default=0) + 1)]
    return Ranked(table, df.columns, [0, *accumulate(many)][:-1], sum(many))


def dense_index(df: DataFrame, col: str, out_col: str = "label_index", range_rows: int | None = None) -> DataFrame:
    """W2 for any number of values: each different value of a column (no NULL)
    with its number from 0 in ascending order."""
    return ranked(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], range_rows).numbered(out_col)
