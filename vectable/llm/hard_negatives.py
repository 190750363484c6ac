"""12. Hard-negative mining: threshold joins with bounded inverted lists.

Anchors are a stated set of rows, searched against all rows. An anchor's
positives are its best rows of the same label; the negatives of a positive are
the best rows of other labels whose score lies in a window under the positive's.
Both are found by one threshold join (``search_cell``), in the manner of L2AP:

1. Dimensions are taken in falling order of their sum of squares, ``CHUNK`` at a
   time. A row is in the inverted list of a chunk only as long as the norm of
   the dimensions from there on, times the largest such norm of the anchors,
   reaches the least threshold; the rest of the row is left out of the index.
2. Scores are accumulated list by list; a pair goes when its partial score and
   the product of both remaining norms stay under the anchor's threshold.
3. Pairs that are left get the components that were not indexed, exactly.

Thresholds start where a bounded sample of the rows (``SAMPLE``) lets expect a
few more rows than a window takes, and are lowered for the anchors whose windows
have not filled, at last to the windows' ends, where nothing is left out: the
result is exact whatever the sample. An anchor's lowest window fills last, as
the others hold the same rows and more above the threshold.

Rows lie in blocks, dealt to cells of about ``CELL_ROWS`` rows; the anchors are
dealt to groups of about ``CELL_ANCHORS``, and each group meets each cell as
packed rows, so no cell grows with the table or with a label. A cell returns the
best rows of each window. Scores are integers throughout.

Cases: rows with a null id, a null label, a null or empty vector or one with a
null or non-finite component take no part. A repeated id counts for each of its
rows, but is one anchor (its least label and vector), and never a partner of
itself. An empty table, no anchors, or no row of another label give no rows.
Vectors of unequal lengths, or so large that a score exceeds 64 bits, raise an
error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectable.llm.blocks import dropped, stored
from vectable.llm.int_vectors import components_of, int_blocks, shape
from vectable.llm.words import mix

SAMPLE, SAMPLE_BYTES, EXPECTED, LOWER = 4096, 8 << 20, 8, 8
CHUNK, CELL_ROWS, CELL_ANCHORS, CELLS = 8, 65_536, 32_768, 32
PART_ROWS, PART_ANCHORS = 4096, 256
FAR = 1 << 62
#: Shares of pairs under which they are followed one by one.
FEW = 0.1

#: Anchors, their thresholds by round, and their windows from the highest: numbers, tops and ends.
ASKING = "id long, key long, v binary, levels array<long>, w array<int>, tops array<long>, lows array<long>"


class Lists:
    """Inverted lists of some rows: for each chunk of dimensions, the rows (a
    leading part of them, sorted) whose index goes that far."""

    def __init__(self, x: np.ndarray, least: float, reach: np.ndarray):
        dim = x.shape[1]
        self.edges = [*range(0, dim, CHUNK), dim]
        self.rest = rest_norms(x, self.edges)
        ends = len(self.edges) - 1
        beyond = (self.rest[:, :ends] * reach[None, :ends] < least) if least > 0 else np.zeros((len(x), ends), bool)
        need = np.where(beyond.any(axis=1), beyond.argmax(axis=1), ends)
        self.order = np.argsort(-need, kind="stable")
        self.x, self.rest, self.need = x[self.order], self.rest[self.order], need[self.order]
        self.many = [int((self.need > c).sum()) for c in range(ends)]

    def pairs(self, q: np.ndarray, q_rest: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs of a score of ``t`` or more."""
        ends = len(self.edges) - 1
        n = self.many[0] if ends else 0
        part = np.zeros((len(q), n), dtype=q.dtype)
        for c in range(ends):
            a, low, high = self.many[c], self.edges[c], self.edges[c + 1]
            if not a:
                break
            part[:, :a] += q[:, low:high] @ self.x[:a, low:high].T
            if c + 1 in (ends // 2, 3 * ends // 4) and c + 1 < ends:
                alive = self._alive(part, q_rest, t, c + 1)
                if alive.mean() < FEW:
                    return self._followed(q, q_rest, t, part, alive, c + 1)
        return self._followed(q, q_rest, t, part, self._alive(part, q_rest, t, ends), ends)

    def _alive(self, part: np.ndarray, q_rest: np.ndarray, t: np.ndarray, c: int) -> np.ndarray:
        """Pairs that can still reach the threshold after ``c`` chunks, by the norms of what is not summed."""
        n = part.shape[1]
        alive = np.empty(part.shape, dtype=bool)
        summed = np.minimum(self.need[:n], c)
        for s in np.unique(summed):
            at = np.flatnonzero(summed == s)  # a run, as rows are sorted by it
            cut = slice(at[0], at[-1] + 1)
            bound = np.outer(q_rest[:, s] * 1.0001, self.rest[cut, s]).astype(part.dtype if part.dtype.kind == "f" else np.float64)
            alive[:, cut] = part[:, cut] + bound + 0.5 >= t[:, None]
        return alive

    def _followed(self, q: np.ndarray, q_rest: np.ndarray, t: np.ndarray, part: np.ndarray, alive: np.ndarray, done: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j = np.nonzero(alive)
        score = part[i, j]
        for c in range(len(self.edges) - 1):
            # Lists after ``done``, and components that were not indexed.
            open_ = np.flatnonzero(np.minimum(self.need[j], done) <= c)
            if not len(open_):
                continue
            low, high = self.edges[c], self.edges[c + 1]
            for k in range(0, len(open_), 1 << 18):
                o = open_[k : k + (1 << 18)]
                score[o] += np.einsum("ij,ij->i", q[i[o], low:high], self.x[j[o], low:high])
            if c + 1 >= done:
                far = score + q_rest[i, c + 1] * self.rest[j, c + 1] * 1.0001 + 0.5 < t[i]
                # Rows whose list ended before ``done`` are summed to here too.
                i, j, score = i[~far], j[~far], score[~far]
        kept = score >= t[i]
        return i[kept], self.order[j[kept]], score[kept]


def rest_norms(x: np.ndarray, edges: list[int]) -> np.ndarray:
    """For each row, the norm of the dimensions from each edge on."""
    squares = np.add.reduceat(x.astype(np.float64) ** 2, edges[:-1], axis=1)
    out = np.zeros((len(x), len(edges)))
    out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return out


def _first(anchor: np.ndarray, window: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each anchor and window, ties to smaller ids."""
    order = np.lexsort((ids, -scores, window, anchor))
    a, w = anchor[order], window[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
    start = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < k]


def search_cell(rows: np.ndarray, ids: np.ndarray, keys: np.ndarray, q: np.ndarray, q_ids: np.ndarray, q_keys: np.ndarray, t: np.ndarray, windows: list, k: int, same: bool) -> tuple:
    """(anchor place, window, id, score): the ``k`` best rows of each window of
    each anchor, of its label (``same``) or of others, that reach ``t``."""
    many = np.array([len(w) for w in windows])
    width = int(many.max())
    number = np.full((len(q), width), -1, np.int64)
    tops, lows = np.full((len(q), width), -FAR, np.int64), np.full((len(q), width), FAR, np.int64)
    for i, w in enumerate(windows):
        for at, (no, top, low) in enumerate(w):
            number[i, at], tops[i, at], lows[i, at] = no, top, low
    t = t.astype(np.int64).copy()
    held = [np.empty(0, np.int64) for _ in range(4)]  # anchor, place of the window, id, score
    by_threshold = np.argsort(-t, kind="stable")
    edges = [*range(0, q.shape[1], CHUNK), q.shape[1]]
    for r in range(0, len(rows), PART_ROWS):
        cut = slice(r, r + PART_ROWS)
        new = [held]
        for a in range(0, len(q), PART_ANCHORS):
            mine = by_threshold[a : a + PART_ANCHORS]
            q_rest = rest_norms(q[mine], edges)
            limit = t[mine].astype(np.float64)
            i, j, s = Lists(rows[cut], float(limit.min()), q_rest.max(axis=0) * 1.0001).pairs(q[mine], q_rest, limit)
            i, s = mine[i], s.astype(np.int64)
            other = ids[cut][j] != q_ids[i]
            fits = other & ((keys[cut][j] == q_keys[i]) == same)
            i, j, s = i[fits], ids[cut][j[fits]], s[fits]
            for w in range(width):
                inside = (s >= lows[i, w]) & (s <= tops[i, w])
                new.append([i[inside], np.full(int(inside.sum()), w), j[inside], s[inside]])
        joined = [np.concatenate(x) for x in zip(*new, strict=True)]
        at = _first(*joined, k)
        held = [x[at] for x in joined]
        # An anchor whose lowest window is full needs no row under its last one.
        low = held[1] == many[held[0]] - 1
        full = np.bincount(held[0][low], minlength=len(q)) == k
        last = np.full(len(q), FAR, np.int64)
        np.minimum.at(last, held[0][low], held[3][low])
        t = np.where(full, np.maximum(t, last), t)
    return held[0], number[held[0], held[1]], held[2], held[3]


def hard_negatives(
    vectors: DataFrame,
    anchors: str,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for each row where ``anchors`` (SQL) holds, each of its
    ``positives`` best rows of the same label, and the ``negatives`` best rows
    of other labels with ``low * positive_score <= 100 * negative_score <= high
    * positive_score``. Scores are inner products of ``floor(scale * x)``."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[label_col]
    key = F.col(label_col).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(label_col)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), key.alias("key"), F.coalesce(F.expr(anchors), F.lit(False)).alias("asks"), F.col(vec_col).alias("v"))
    blocks = int_blocks(rows, ["id", "key", "asks"], "v", scale)
    n, dim, biggest = shape(blocks)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], schema)
    bound = biggest**2 * dim
    if bound >= 2.0**63:
        raise ValueError(f"scores of up to {bound:.3g} do not fit 64 bits")
    dtype = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    squares = blocks.select(F.posexplode("squares")).groupBy("pos").agg(F.sum("col").alias("s")).collect()  # one row for each dimension
    order = np.array([r["pos"] for r in sorted(squares, key=lambda r: (-r["s"], r["pos"]))])

    # Anchors, each id once, and a bounded sample of all rows.
    size = int(max(1, min(SAMPLE, SAMPLE_BYTES // (4 * dim))))
    share = min(1.0, 3 * size / n)

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                x = components_of(b["data"], dim)[:, order]
                ids, keys, asks = np.array(b["id"], np.int64), np.array(b["key"], np.int64), np.array(b["asks"], bool)
                hashed = mix(ids.view(np.uint64))
                lot = (hashed >> np.uint64(11)).astype(np.float64) / 2**53
                at = np.flatnonzero(asks | (lot < share))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(keys[at]), pa.array(asks[at]), pa.array(lot[at]), pa.array([x[i].tobytes() for i in at], pa.binary())], ["id", "key", "asks", "lot", "v"]
                )

    taken = stored(blocks.select("id", "key", "asks", "data").mapInArrow(picked, "id long, key long, asks boolean, lot double, v binary"), "picked")
    asking = taken.where("asks").groupBy("id").agg(F.min(F.struct("key", "v")).alias("r")).select("id", "r.key", "r.v")
    few = taken.orderBy("lot", "id", "key", "v").limit(size).select("id", "key", "v").toPandas()
    sample = spark.sparkContext.broadcast((few["id"].to_numpy(), few["key"].to_numpy(), np.array([np.frombuffer(v, np.int32) for v in few["v"]], np.float64).reshape(-1, dim)))
    rank = max(1, -(-EXPECTED * len(few) // n))

    def levels(asked: DataFrame, same: bool) -> DataFrame:
        """Thresholds of each round: under the top of the lowest window, the
        sample's scores at a rank and at a lower one, and the window's end."""

        def fn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, keys, x = sample.value
            for whole in frames:
                for at in range(0, len(whole), PART_ANCHORS):
                    pdf = whole.iloc[at : at + PART_ANCHORS].copy()
                    q = np.array([np.frombuffer(v, np.int32) for v in pdf["v"]], np.float64).reshape(-1, dim)
                    own, label = pdf["id"].to_numpy()[:, None], pdf["key"].to_numpy()[:, None]
                    top = np.array([x[-1] for x in pdf["tops"]], np.float64)[:, None]
                    end = np.array([x[-1] for x in pdf["lows"]], np.int64)
                    s = q @ x.T
                    s = np.where((own != ids) & ((label == keys) == same) & (s <= top), s, -np.inf)
                    s = -np.sort(-s, axis=1)
                    out = []
                    for r in (rank, rank * LOWER):
                        at_rank = s[:, r - 1] if r <= s.shape[1] else np.full(len(s), -np.inf)
                        out.append(np.maximum(np.where(np.isfinite(at_rank), at_rank, -FAR).astype(np.int64), end))
                    pdf["levels"] = list(np.column_stack([*out, end]))
                    yield pdf[["id", "key", "v", "levels", "w", "tops", "lows"]]

        return stored(asked.select("id", "key", "v", "w", "tops", "lows").mapInPandas(fn, ASKING), "asking")

    groups = max(CELLS, -(-n // CELL_ROWS))

    def best(asked: DataFrame, level: int, k: int, same: bool) -> DataFrame:
        """The ``k`` best rows of each window, down to the round's threshold."""
        parts = max(1, -(-asked.count() // CELL_ANCHORS))

        def fn(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"anchor": [], "w": [], "partner": [], "score": []})
            x = np.concatenate([components_of(b, dim) for b in left["data"]])[:, order].astype(dtype)
            q = np.array([np.frombuffer(v, np.int32) for v in right["v"]]).reshape(-1, dim).astype(dtype)
            windows = [list(zip(*three, strict=True)) for three in zip(right["w"], right["tops"], right["lows"], strict=True)]
            own = right["id"].to_numpy()
            a, w, ids, scores = search_cell(x, np.concatenate(left["id"].tolist()), np.concatenate(left["key"].tolist()), q, own, right["key"].to_numpy(), right["t"].to_numpy(), windows, k, same)
            return pd.DataFrame({"anchor": own[a], "w": w, "partner": ids, "score": scores})

        cells = blocks.select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"), "id", "key", "data")
        asks = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("p"), "id", "key", "v", F.col("levels")[level].alias("t"), "w", "tops", "lows")
        found = cells.groupBy("g", "p").cogroup(asks.groupBy("g", "p")).applyInPandas(fn, "anchor long, w int, partner long, score long")
        order_by = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "partner")
        return stored(found.withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= k), "windows")

    def filled(asked: DataFrame, k: int, same: bool) -> DataFrame:
        """``anchor, w, partner, score, rank`` of all windows, thresholds lowered until they fill."""
        asked = levels(asked, same)
        done: list[DataFrame] = []
        for level in range(3):
            found = best(asked, level, k, same)
            ends = asked.select(F.col("id").alias("anchor"), F.element_at("w", -1).alias("w"), (F.col("levels")[level] <= F.element_at("lows", -1)).alias("ended"))
            counts = found.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n"))
            state = ends.join(counts, ["anchor", "w"], "left").select("anchor", (F.col("ended") | (F.coalesce("n", F.lit(0)) >= k)).alias("full"))
            state = stored(state, "filled")
            done.append(found.join(state.where("full").select("anchor"), "anchor", "left_semi"))
            rest = stored(asked.join(state.where("NOT full").select(F.col("anchor").alias("id")), "id", "left_semi"), "asking")
            dropped(asked)
            asked = rest
            if asked.isEmpty():
                break
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return out

    everything = asking.select("*", F.array(F.lit(1)).alias("w"), F.array(F.lit(FAR)).alias("tops"), F.array(F.lit(-FAR)).alias("lows"))
    found = stored(filled(everything, positives, True), "positives")
    # The window under each positive, from the highest; empty ones are left out.
    s, rest = F.col("score"), F.pmod("score", F.lit(100))
    hundreds = F.expr("(score - pmod(score, 100)) div 100")
    top = hundreds * high + F.floor(rest * high / F.lit(100.0)).cast("long")
    least = hundreds * low + F.ceil(rest * low / F.lit(100.0)).cast("long")
    windows = found.select("anchor", F.col("rank").alias("w"), top.alias("top"), least.alias("low")).where("top >= low")
    windows = windows.groupBy(F.col("anchor").alias("id")).agg(F.sort_array(F.collect_list(F.struct("w", "top", "low"))).alias("s"))
    asked = asking.join(windows.select("id", "s.w", F.col("s.top").alias("tops"), F.col("s.low").alias("lows")), "id")
    mined = filled(asked, negatives, False).select("anchor", "w", "rank", F.col("partner").alias("negative_id"), F.col("score").alias("negative_score"))
    named = found.select("anchor", F.col("rank").alias("w"), F.col("partner").alias("positive_id"), s.alias("positive_score"))
    return named.join(mined, ["anchor", "w"]).select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def oracle_sql() -> str:
    """The query over ``embeddings`` in DuckDB SQL: all anchors against all rows."""
    return """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM e a JOIN e r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
