"""13. Vector code compression: codebooks by part, with adaptive distance bounds.

Vectors of integers are cut into equal parts; each part position has a codebook,
refined by rounds of assignment to the nearest entry and componentwise floored
means (k-means). Rounds avoid most distances in the manner of Drake and Hamerly:
each part keeps its ``b`` closest entries with lower bounds, in order, and one
outer bound for all others. When entries move, a bound falls by its entry's move
and the outer bound by the largest move. A part whose distance to its own entry
is under all its bounds keeps it. Otherwise the entries whose bounds do not
exceed that distance are measured, in whole numbers, and where the outer bound
does not either, all entries are. Bounds are rounded down, so whatever they
leave open, ties included (to the lower index), is decided by exact integer
distances.

``b`` starts at a quarter of the entries; after each round it follows what the
parts needed: twice as many where over ``TOO_MANY`` of them met the outer bound,
otherwise as many as ``ENOUGH`` of the uncertain ones looked at, at least an
eighth of the entries.

Vectors lie in packed blocks; a round is one narrow pass that reads the blocks'
table and writes the next one, with the bounds, and a row of sums and counts for
each task, added up by Spark. Only codebooks (parts x entries) reach the driver,
and a table goes when the next one is written. A lost executor repeats its tasks
from the table before.

Cases: vectors that are null or empty or hold a null or non-finite component are
dropped; null ids are kept and count as the largest; of a repeated id every row
counts, ordered by its vector. With fewer rows than entries the codebook is
smaller; equal entries leave the higher one unused; an empty table gives no rows.
Unequal lengths, a length that ``parts`` does not divide, or components beyond 28
bits raise an error. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import dropped, expand, squeeze, stored
from vectable.llm.int_vectors import components_of, int_blocks, shape
from vectable.operators.common import small_or_plain

NONE, WORST = 255, np.iinfo(np.int64).max
TOO_MANY, ENOUGH = 0.1, 0.99
STATE = ["block", "id", "label", "data", "near", "lower", "outer", "sums"]


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    d = x - entries
    return np.einsum("...i,...i->...", d, d)


def _under(d: np.ndarray) -> np.ndarray:
    """A distance rounded down, from its exact square."""
    return np.maximum(0.0, np.sqrt(d.astype(np.float64)) * (1 - 1e-6) - 1e-6)


def _over(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 + 1e-6) + 1e-6


class Bounds:
    """The closest entries of some parts at one position, the assigned one first."""

    def __init__(self, near: np.ndarray, lower: np.ndarray, outer: np.ndarray):
        self.near, self.lower, self.outer = near, lower, outer

    @classmethod
    def measured(cls, x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
        d = _squares(x[:, None, :], book[None, :, :])
        order = np.argsort(d, axis=1, kind="stable")[:, : b + 1]
        lower = _under(np.take_along_axis(d, order, axis=1))
        outer = lower[:, b] if b < len(book) else np.full(len(x), np.inf)
        return cls(order[:, :b].astype(np.uint8), lower[:, :b], outer)

    def resized(self, b: int) -> Bounds:
        """With ``b`` places: empty ones added, or the last ones under the outer bound."""
        have = self.near.shape[1]
        if b > have:
            more = ((0, 0), (0, b - have))
            return Bounds(np.pad(self.near, more, constant_values=NONE), np.pad(self.lower, more, constant_values=np.inf), self.outer)
        if b < have:
            return Bounds(self.near[:, :b], self.lower[:, :b], np.minimum(self.outer, self.lower[:, b:].min(axis=1)))
        return self

    def moved(self, x: np.ndarray, book: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, int]:
        """Follow a new codebook, whose entries moved by ``drift``. Returns how
        many places each uncertain part looked at, and how many parts were
        measured against all entries."""
        step = np.zeros(NONE + 1)
        step[: len(drift)] = drift
        self.lower = self.lower - step[self.near]
        self.outer = self.outer - drift.max()
        b = self.near.shape[1]
        own = _squares(x, book[self.near[:, 0]])
        reach = _over(own)
        rival = np.minimum(self.outer, self.lower[:, 1:].min(axis=1)) if b > 1 else self.outer
        self.lower[:, 0] = _under(own)
        at = np.flatnonzero(rival <= reach)
        if not len(at):
            return np.empty(0, np.int64), 0
        near, lower = self.near[at], self.lower[at]
        d = np.full(near.shape, WORST, np.int64)
        d[:, 0] = own[at]
        look = (lower <= reach[at, None]) & (near != NONE)
        look[:, 0] = False
        i, j = np.nonzero(look)
        d[i, j] = _squares(x[at[i]], book[near[i, j]])
        lower[i, j] = _under(d[i, j])
        least = d.min(axis=1)
        best = np.where(d == least[:, None], near, NONE).min(axis=1)
        order = np.argsort(np.where(near == best[:, None], -1.0, lower), axis=1, kind="stable")
        self.near[at], self.lower[at] = np.take_along_axis(near, order, axis=1), np.take_along_axis(lower, order, axis=1)
        used = np.where(look.any(axis=1), b - np.argmax(look[:, ::-1], axis=1), 1)
        all_ = at[self.outer[at] <= _over(least)]
        if len(all_):
            new = Bounds.measured(x[all_], book, b)
            self.near[all_], self.lower[all_], self.outer[all_] = new.near, new.lower, new.outer
        return used, len(all_)


def next_width(b: int, entries: int, used: np.ndarray, all_: int, parts: int) -> int:
    """How many closest entries the next round keeps. ``used`` counts uncertain
    parts by the places they looked at."""
    if all_ > TOO_MANY * parts:
        return min(2 * b, max(1, entries - 1))
    known = np.cumsum(used)
    enough = int(np.searchsorted(known, ENOUGH * known[-1])) if known[-1] else 0
    return min(entries, max(2, entries // 8, enough))


def refined(codebook: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Floored means; entries without parts stay."""
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], codebook)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """``<id_col>, code, error, label_error, codebooks_sha256``: two hex digits
    for each part, the squared distances of its parts to their entries, their
    sum over the rows of the same label, and the digest of all final entries."""
    if not 0 < entries < NONE:
        raise ValueError(f"1 to {NONE - 1} entries, not {entries}")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    kinds = dict(rows.dtypes)
    blocks = int_blocks(rows, ["id", "label"], "v", scale)
    n, dim, biggest = shape(blocks)
    if not n:
        return spark.createDataFrame([], f"`{id_col}` {kinds['id']}, code string, error long, label_error long, codebooks_sha256 string")
    if dim % parts:
        raise ValueError(f"{parts} parts do not divide a length of {dim}")
    if biggest >= 2**28 or dim // parts > 128:
        raise ValueError("parts too large for exact 64-bit distances")
    w = dim // parts

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's first rows by id, nulls last."""
        for batch in batches:
            for b in batch.to_pylist():
                x = components_of(b["data"], dim)
                order = sorted(range(len(x)), key=lambda i: (b["id"][i] is None, b["id"][i] if b["id"][i] is not None else 0, x[i].tolist()))[:entries]
                yield pa.RecordBatch.from_arrays([pa.array([b["id"][i] for i in order], batch.column(0).type.value_type), pa.array([x[i].tolist() for i in order], pa.list_(pa.int64()))], ["id", "v"])

    first = blocks.select("id", "data").mapInArrow(smallest, f"id {kinds['id']}, v array<long>").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    book = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, w).transpose(1, 0, 2)
    k = len(first)
    types = list(rows.select("id", "label").limit(0).toArrow().schema.types)
    state_schema = f"block long, id array<{kinds['id']}>, label array<{kinds['label']}>, data binary, near binary, lower binary, outer binary, sums array<long>"

    def a_round(state: DataFrame, book: np.ndarray, drift: np.ndarray | None, b: int, last: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast((book, drift))

        def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            book, drift = shared.value
            sums, counts = np.zeros((parts, k, w), np.int64), np.zeros((parts, k), np.int64)
            used, all_ = np.zeros(NONE + 1, np.int64), 0
            for batch in batches:
                names = batch.schema.names
                for r in range(batch.num_rows):
                    cell = {c: batch.column(names.index(c))[r].as_py() for c in names if c not in ("id", "label")}
                    x = components_of(cell["data"], dim).astype(np.int64).reshape(-1, parts, w)
                    m = len(x)
                    near, lower, outer = np.empty((parts, m, b), np.uint8), np.empty((parts, m, b), np.float32), np.empty((parts, m), np.float32)
                    old = drift is not None and [expand(cell[c], t).reshape(parts, m, -1) for c, t in (("near", np.uint8), ("lower", np.float32), ("outer", np.float32))]
                    for p in range(parts):
                        if drift is None:
                            bounds = Bounds.measured(x[:, p], book[p], b)
                            all_ += m
                        else:
                            bounds = Bounds(old[0][p], old[1][p].astype(np.float64), old[2][p, :, 0].astype(np.float64)).resized(b)
                            bounds.near = bounds.near.copy()
                            looked, whole = bounds.moved(x[:, p], book[p], drift[p])
                            used += np.bincount(looked, minlength=NONE + 1)
                            all_ += whole
                        near[p] = bounds.near
                        lower[p] = np.nextafter(bounds.lower.astype(np.float32), np.float32(-np.inf))
                        outer[p] = np.nextafter(bounds.outer.astype(np.float32), np.float32(-np.inf))
                        own = bounds.near[:, 0]
                        counts[p] += np.bincount(own, minlength=k)
                        sums[p] += np.stack([np.bincount(own, weights=x[:, p, i], minlength=k) for i in range(w)], axis=1).astype(np.int64)
                    kept = [pa.ListArray.from_arrays(pa.array([0, m], pa.int32()), batch.column(names.index(c))[r].values) for c in ("id", "label")]
                    columns = [pa.array([cell["block"]], pa.int64()), *kept]
                    binary = [cell["data"], squeeze(near), None if last else squeeze(lower), None if last else squeeze(outer)]
                    yield pa.RecordBatch.from_arrays([*columns, *[pa.array([y], pa.binary()) for y in binary], pa.array([None], pa.list_(pa.int64()))], STATE)
            told = np.concatenate([sums.ravel(), counts.ravel(), used, [all_]])
            ends = [pa.array([-1], pa.int64()), *[pa.array([None], pa.list_(t)) for t in types], *[pa.array([None], pa.binary())] * 4, pa.array([told], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(ends, STATE)

        return stored(state.mapInArrow(fn, state_schema), "codes")

    state, drift, b = blocks.select("block", "id", "label", "data"), None, min(k, max(2, entries // 4))
    for r in range(rounds + 1):
        new = a_round(state, book, drift, b, r == rounds)
        if hasattr(state, "_vectable_path"):
            dropped(state)
        state = new.where("block >= 0")
        state._vectable_path = new._vectable_path
        if r == rounds:
            break
        told = new.where("block < 0").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()  # parts x entries x (width + 1) numbers
        flat = np.zeros(len(told), np.int64)
        flat[[t["pos"] for t in told]] = [t["s"] for t in told]
        sums, counts, used, all_ = np.split(flat, np.cumsum([parts * k * w, parts * k, NONE + 1]))
        moved = refined(book, sums.reshape(parts, k, w), counts.reshape(parts, k))
        drift = _over(_squares(moved, book)) * (moved != book).any(axis=2)
        if r:
            b = next_width(b, k, used, int(all_[0]), n * parts)
        book = moved
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    final = book

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x = components_of(batch.column(2)[r].as_py(), dim).astype(np.int64).reshape(-1, parts, w)
                own = expand(batch.column(3)[r].as_py(), np.uint8).reshape(parts, len(x), -1)[:, :, 0]
                error = sum(_squares(x[:, p], final[p][own[p]]) for p in range(parts))
                text = [bytes(row).hex() for row in np.ascontiguousarray(own.T)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[r].values, batch.column(1)[r].values, pa.array(text), pa.array(error)], ["id", "label", "code", "error"])

    out = stored(state.select("id", "label", "data", "near").mapInArrow(coded, f"id {kinds['id']}, label {kinds['label']}, code string, error long"), "coded")
    dropped(state, blocks)
    by_label = out.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    joined = out.join(small_or_plain(by_label), F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The query over ``embeddings`` in DuckDB SQL, round by round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, [floor({scale} * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)""",
        f"piece AS MATERIALIZED (SELECT rid, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM kept, range({parts}) AS r(p))",
        f"start AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS j FROM kept QUALIFY j < {entries})",
        "book0 AS MATERIALIZED (SELECT p, j, x AS c FROM piece JOIN start USING (rid))",
    ]
    near = """(
  SELECT rid, p, j, x, d FROM (
    SELECT rid, p, j, x, list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS d FROM piece JOIN book{r} USING (p)
  ) QUALIFY row_number() OVER (PARTITION BY rid, p ORDER BY d, j) = 1
)"""
    for r in range(rounds):
        steps.append(f"own{r} AS MATERIALIZED {near.format(r=r)}")
        steps.append(
            f"""mean{r} AS (
  SELECT p, j, list(m ORDER BY i) AS m FROM (
    SELECT p, j, i, floor(sum(x[i]) / count(*)) AS m FROM own{r}, range(1, (SELECT len(any_value(x)) + 1 FROM piece)) AS q(i) GROUP BY p, j, i
  ) GROUP BY p, j
)"""
        )
        steps.append(f"book{r + 1} AS MATERIALIZED (SELECT p, j, coalesce(m, c) AS c FROM book{r} LEFT JOIN mean{r} USING (p, j))")
    steps.append(f"own AS MATERIALIZED {near.format(r=rounds)}")
    steps.append("coded AS (SELECT rid, string_agg(printf('%02x', j), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM own GROUP BY rid)")
    steps.append(f"digest AS (SELECT sha256(string_agg(list_aggregate([v::BIGINT::VARCHAR FOR v IN c], 'string_agg', ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM book{rounds})")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), digest"""
