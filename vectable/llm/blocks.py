"""Documents in packed blocks, and exact corpus-wide counts for their keys.

Some operators need, for every document, how often each of its n-grams occurs
in the whole corpus. Shuffling one row for each occurrence and back costs
many times the input; here documents are packed into blocks of a few MB
(compressed, written once to the shared folder), each block sends its
*distinct* keys with local counts to hash buckets, every bucket adds up its
keys, and each block gets back the totals of its own keys in its own order.
A key that occurs everywhere is one entry a block, so no bucket is hot.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.session import scratch_path

#: Bytes of text in a block, and distinct keys that a bucket should hold.
BLOCK_BYTES = 2 << 20
BUCKET_KEYS = 1 << 19
#: Bytes of a batch that a task works on, and sends back, at a time.
SLICE_BYTES = 2 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later jobs start
    from the table, and lost executors don't bring back the work before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._vectable_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(df._vectable_path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of texts in slices of about ``SLICE_BYTES`` (a row at least), in
    order: a batch has thousands of rows, and what is made of all of them and
    sent back at once stays in the memory of the worker and of the executor."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def give_back() -> None:
    """What this process has freed goes back to the system. A worker is used
    again by all later stages, and would hold as much as the largest of them took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def tidy(fn: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``fn`` over the batches of a task, whose worker gives back what it freed at the end."""

    def run(batches: Iterator) -> Iterator:
        yield from fn(batches)
        give_back()

    return run


def pack(docs: DataFrame, id_col: str, text_col: str, kind: str = "0") -> DataFrame:
    """Blocks ``(block, kind, ids, sizes, data)`` of all documents, written once.

    ``kind`` is a SQL expression of a small int; a block holds documents of one
    kind. Null texts count as empty. ``data`` holds the UTF-8 texts, one after
    the other, compressed.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.expr(kind).cast("int").alias("kind")
    )

    def block(k: int, at: int, part: list) -> pa.RecordBatch:
        ids, texts = [x[0] for x in part], [x[1] for x in part]
        data = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int64()), pa.array([k], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(x) for x in texts]], pa.list_(pa.int64())), pa.array([data], pa.binary())],
            ["block", "kind", "ids", "sizes", "data"],
        )

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        open_: dict[int, list] = {}
        size: dict[int, int] = {}
        for batch in batches:
            for i, text, k in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py()
                open_.setdefault(k, []).append((i, text))
                size[k] = size.get(k, 0) + len(text) + 16
                if size[k] >= BLOCK_BYTES:
                    yield block(k, at, open_.pop(k))
                    at, size[k] = at + 1, 0
        for k, part in open_.items():
            yield block(k, at, part)
            at += 1

    return stored(rows.mapInArrow(tidy(fn), "block long, kind int, ids array<long>, sizes array<long>, data binary"), "blocks")


def texts_of(sizes: np.ndarray, data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(sum(sizes)) or 1)
    ends = np.cumsum(sizes)
    return [raw[e - s : e] for s, e in zip(sizes, ends, strict=True)]


def bucket_bits(blocks: DataFrame, keys_a_byte: float = 0.2) -> int:
    """How many leading bits of a key name its bucket, from the size of all texts."""
    size = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    return int(min(30, max(6, np.ceil(np.log2(max(1.0, size * keys_a_byte / BUCKET_KEYS))))))


def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def expand(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=kind)


def keys_to_bytes(keys: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def keys_from_bytes(x: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(x) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(x, dtype=np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


#: A row for each block, family of keys and bucket. ``counts`` holds, for each key, one uint32 for each counter.
SENT = "bucket int, family int, block long, keys binary, counts binary"


def to_buckets(block: int, family: int, keys: np.ndarray, counts: np.ndarray, bits: int, width: int) -> pd.DataFrame:
    """Rows of ``SENT`` for sorted distinct ``keys``; ``counts`` has a row for each counter."""
    top = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    edges = np.concatenate([[0], top, [len(keys)]])
    full = np.flatnonzero(np.diff(edges))
    return pd.DataFrame(
        {
            "bucket": full.astype(np.int32),
            "family": np.int32(family),
            "block": np.int64(block),
            "keys": [keys_to_bytes(keys[edges[i] : edges[i + 1]], width) for i in full],
            "counts": [squeeze(np.ascontiguousarray(counts[:, edges[i] : edges[i + 1]], dtype=np.uint32)) for i in full],
        }
    )


def totals(sent: DataFrame, reply: Callable[[pd.DataFrame, np.ndarray, np.ndarray], Iterator[pd.DataFrame]], counters: int, width: int, schema: str) -> DataFrame:
    """For each bucket and family: ``reply(rows, inverse, sums)`` where ``sums``
    has the corpus-wide total of every counter for each distinct key, and
    ``inverse`` says which of them each key of each row is, row after row."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        give_back()
        keys = np.concatenate([keys_from_bytes(x, width) for x in pdf["keys"]])
        counts = np.concatenate([expand(x, np.uint32).reshape(counters, -1) for x in pdf["counts"]], axis=1)
        uniq, inverse = np.unique(keys, return_inverse=True)
        sums = np.stack([np.bincount(inverse, weights=c, minlength=len(uniq)).astype(np.int64) for c in counts])
        return reply(pdf, inverse, sums)

    return sent.groupBy("family", "bucket").applyInPandas(fn, schema)


def row_slices(pdf: pd.DataFrame, width: int) -> list[slice]:
    ends = np.cumsum([len(x) // width for x in pdf["keys"]])
    return [slice(e - len(x) // width, e) for e, x in zip(ends, pdf["keys"], strict=True)]
