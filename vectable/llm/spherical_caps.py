"""4. Embedding near-dedup: spherical-cap filters.

A filter is a direction on the sphere; a vector passes it when its inner
product exceeds ``alpha``, that is when it lies in the cap around the
direction. Directions are a random product code: after a random rotation the
vector is cut into ``PARTS`` parts, each part has ``k`` random codewords, and
any combination of codewords is a direction, so ``k ** PARTS`` filters need
``PARTS * k`` inner products. A vector is list-decoded to all directions it
passes: codewords of a part in falling order, cut where even the best rest
cannot reach ``alpha``. Near vectors pass common filters; pairs meet there.

Equal vectors are one class first, with its size. The code grows with the
number of classes, so that a filter has about ``CAP_ROWS`` of them, and
``alpha`` is set on a bounded sample of vectors (``SAMPLE``) so that a vector
passes a number of filters on average. That number grows with the code: from
``PASSED`` on, until of ``PAIRS`` pairs made at exactly the cosine wanted, a
sampled vector and a random one at that angle, a share of ``RECALL`` has a
common filter. A vector that passes fewer than ``LEAST`` of that number takes
so many best ones, which near vectors share just as well.

A filter's rows are compared as matrices, in double precision; a pair counts
where its first common filter is, so it is counted once and never written out:
a task returns the links of each row as a count, and enough of the links to
connect the same rows. A filter with over ``BLOCK`` rows is cut into blocks by
hash and compared block by block, so no task holds more than two blocks.

Cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and are kept; null ids are left out; a repeated id is
one vector (its row with the least vector); an empty table gives no rows;
vectors of unequal lengths raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import stored
from vectable.llm.components import components
from vectable.llm.vectors import dimension, matrix, rotation, usable

PARTS, CAP_ROWS, PASSED, LEAST, SAMPLE, BLOCK, GROUP_ROWS = 2, 48, 20, 0.3, 2000, 768, 4096
RECALL, PAIRS, STEP = 0.96, 600, 1.3


class Code:
    """A product code over rotated unit vectors."""

    def __init__(self, dim: int, k: int, parts: int = PARTS, seed: int = 5):
        self.turn = rotation(dim, seed)
        edges = np.linspace(0, dim, min(parts, dim) + 1).astype(int)
        self.parts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        r = np.random.default_rng(seed + 1)
        self.words = []
        for s in self.parts:
            w = r.normal(size=(k, s.stop - s.start))
            self.words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(len(self.parts)))
        self.k, self.alpha, self.least = k, 0.0, 1

    def products(self, x: np.ndarray) -> list[np.ndarray]:
        t = x @ self.turn
        return [t[:, s] @ w.T for s, w in zip(self.parts, self.words, strict=True)]

    def decode(self, scores: list[np.ndarray], alpha: float) -> np.ndarray:
        """Numbers of the directions whose summed score exceeds ``alpha``, of one vector."""
        ids, sums = np.zeros(1, np.int64), np.zeros(1)
        rest = np.cumsum([s.max() for s in scores][::-1])[::-1]
        for i, s in enumerate(scores):
            most = rest[i + 1] if i + 1 < len(scores) else 0.0
            total = sums[:, None] + s[None, :]
            a, b = np.nonzero(total + most > alpha)
            ids, sums = ids[a] * self.k + b, total[a, b]
        return ids

    def best(self, scores: list[np.ndarray], n: int) -> np.ndarray:
        """The ``n`` directions of the highest scores: among the best ``n`` words of each part."""
        ids, sums = np.zeros(1, np.int64), np.zeros(1)
        for s in scores:
            top = np.argsort(-s, kind="stable")[:n]
            total = (sums[:, None] + s[top][None, :]).ravel()
            at = np.argsort(-total, kind="stable")[:n]
            ids, sums = (ids[:, None] * self.k + top[None, :]).ravel()[at], total[at]
        return ids

    def caps(self, x: np.ndarray) -> list[np.ndarray]:
        """Numbers of each row's filters, in rising order."""
        scores, out = self.products(x), []
        for i in range(len(x)):
            own = [s[i] for s in scores]
            c = self.decode(own, self.alpha)
            out.append(np.sort(c if len(c) >= self.least else self.best(own, self.least)))
        return out

    def calibrate(self, x: np.ndarray, passed: float) -> None:
        """``alpha`` such that the rows of ``x`` pass ``passed`` directions each on average."""
        scores = self.products(x)
        low, high = -1.0, 1.0
        for _ in range(25):
            self.alpha = (low + high) / 2
            n = 0.0
            for i in range(len(x)):  # counted without listing them
                total = scores[0][i]
                for s in scores[1:-1]:
                    total = (total[:, None] + s[i][None, :]).ravel()
                last = np.sort(scores[-1][i]) if len(scores) > 1 else np.zeros(1)
                n += (len(last) - np.searchsorted(last, self.alpha - total, side="right")).sum()
            low, high = (self.alpha, high) if n > passed * len(x) else (low, self.alpha)


def pairs_at(x: np.ndarray, cosine: float, n: int, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """``n`` rows of ``x`` and, to each, a random unit vector at exactly ``cosine``."""
    r = np.random.default_rng(seed)
    a = x[r.integers(0, len(x), n)]
    y = r.normal(size=a.shape)
    y -= (y * a).sum(axis=1, keepdims=True) * a
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(max(0.0, 1 - cosine * cosine)) * y


def recall(code: Code, a: np.ndarray, b: np.ndarray) -> float:
    """The share of pairs with a common filter."""
    return float(np.mean([len(np.intersect1d(p, q, assume_unique=True)) > 0 for p, q in zip(code.caps(a), code.caps(b), strict=True)]))


def fitted(x: np.ndarray, dim: int, rows: int, cosine: float) -> Code:
    """The code for ``rows`` vectors of which ``x`` are a sample."""
    passed = float(PASSED)
    while True:
        filters = max(16.0, rows * passed / CAP_ROWS)
        code = Code(dim, int(np.ceil(filters ** (1 / min(PARTS, dim)))))
        most = min(passed, code.k ** len(code.parts) / 2)
        code.least = max(1, int(most * LEAST))
        code.calibrate(x[:400], most)
        # As many filters as rows: nothing is left to gain.
        if not len(x) or dim < 2 or passed >= rows or recall(code, *pairs_at(x, cosine, PAIRS)) >= RECALL:
            code.calibrate(x, most)
            return code
        passed *= STEP


def _fit(units: DataFrame, dim: int, rows: int, cosine: float) -> Code:
    sample = units.orderBy(F.xxhash64("id", F.lit("caps"))).limit(SAMPLE).select("x").collect()
    return fitted(np.array([r["x"] for r in sample]).reshape(len(sample), dim), dim, rows, cosine)


def compare(left: pd.DataFrame, right: pd.DataFrame | None, dim: int, cosine: float) -> tuple[pd.DataFrame, np.ndarray]:
    """Links between the rows of two blocks of a filter (or within one) whose
    first common filter it is: rows ``id, links`` (sum of partners' sizes) and
    an array of pairs that connects what is linked."""
    cap = int(left["cap"].iloc[0])
    both = [left] if right is None else [left, right]
    x = [matrix(p["x"], dim) for p in both]
    a, b = np.nonzero(x[0] @ x[-1].T >= cosine)
    if right is None:
        a, b = a[a < b], b[a < b]
    if len(a):
        # Filters before this one that both pass; only those that several rows pass can be common.
        (ua, ia), (ub, ib) = (np.unique(v, return_inverse=True) for v in (a, b))
        lists = [[c[c < cap] for c in map(np.asarray, p["caps"].iloc[u])] for p, u in ((both[0], ua), (both[-1], ub))]
        every, n = np.unique(np.concatenate([c for v in lists for c in v]), return_counts=True)
        every = every[n > 1]
        held = [np.zeros((len(v), len(every)), np.float32) for v in lists]
        for h, v in zip(held, lists, strict=True):
            for i, c in enumerate(v):
                at = np.searchsorted(every, c)
                at = at[at < len(every)]
                h[i, at[np.isin(every[at], c)]] = 1
        new = (held[0] @ held[1].T)[ia, ib] == 0
        a, b = a[new], b[new]
    ids, sizes = [p["id"].to_numpy() for p in both], [p["size"].to_numpy() for p in both]
    links = [np.bincount(a, weights=sizes[-1][b], minlength=len(ids[0])), np.bincount(b, weights=sizes[0][a], minlength=len(ids[-1]))]
    if right is None:
        counted = pd.DataFrame({"id": ids[0], "links": links[0] + links[1]})
    else:
        counted = pd.concat([pd.DataFrame({"id": i, "links": n}) for i, n in zip(ids, links, strict=True)])
    # A spanning forest: hook each pair's larger root to the smaller one.
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            parent[v] = parent.get(up, up)
            v = up
        return v

    pairs = []
    for u, v in zip(ids[0][a].tolist(), ids[-1][b].tolist(), strict=True):
        p, q = root(u), root(v)
        if p != q:
            parent[max(p, q)] = min(p, q)
            pairs.append((u, v))
    counted["links"] = counted["links"].astype(np.int64)
    return counted[counted["links"] > 0], np.array(pairs, dtype=np.int64).reshape(-1, 2)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links`` (other vectors at ``cosine``
    or more), ``component_id`` (least id that links reach), ``kept`` (whether
    it is that one)."""
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda v: v.cast("double")).alias("v"))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    dim = dimension(rows, "v") or 1
    # Equal directions are one class: the same unit vector, to the last bit.
    scale = F.aggregate("v", F.lit(0.0), lambda t, v: F.greatest(t, F.abs(v)))
    small = F.transform("v", lambda v: v / F.col("scale"))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda t, v: t + v * v))
    good = rows.where(usable("v")).withColumn("scale", scale).withColumn("s", small).withColumn("norm", norm)
    unit = stored(good.select("id", F.transform("s", lambda v: v / F.col("norm") + F.lit(0.0)).alias("x")), "units")
    keyed = unit.withColumn("h1", F.xxhash64("x")).withColumn("h2", F.xxhash64("x", F.lit(1)))
    classes = stored(keyed.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size")), "classes")
    reps = stored(unit.join(classes.select("id", "size"), "id"), "reps")
    code = _fit(reps, dim, classes.count(), cosine)
    shared = vectors.sparkSession.sparkContext.broadcast(code)  # PARTS * k codewords

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = shared.value
        for pdf in frames:
            for at in range(0, len(pdf), 2048):
                part = pdf.iloc[at : at + 2048]
                yield part.assign(caps=code.caps(matrix(part["x"], dim)))

    decoded = stored(reps.select("id", "size", "x").mapInPandas(decode, "id long, size long, x array<double>, caps array<long>"), "caps")
    sizes = stored(decoded.select(F.explode("caps").alias("cap")).groupBy("cap").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cap_sizes")
    posted = decoded.select(F.explode("caps").alias("cap"), "id", "size", "x", "caps").join(sizes, "cap")
    # Block (i, j) compares two blocks of one filter: a row goes to all blocks that its own one is in.
    n = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    posted = posted.withColumn("k", n).withColumn("b", F.pmod(F.xxhash64("id", "cap"), F.col("k")).cast("int"))
    other = posted.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = other.select("cap", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "id", "size", "x", "caps")

    # Filters are many and small: a task group takes whole ones, about ``GROUP_ROWS`` rows in all.
    total = sizes.agg(F.sum(F.col("n") * F.ceil(F.col("n") / F.lit(BLOCK)))).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP_ROWS))
    dealt = dealt.withColumn("g", F.pmod(F.xxhash64("cap", "i", "j"), F.lit(groups)))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), part in pdf.groupby(["cap", "i", "j"], sort=False):
            left, right = part[part["b"] == i], None if i == j else part[part["b"] == j]
            if len(left) < 2 and right is None or len(left) == 0 or right is not None and len(right) == 0:
                continue
            counted, pairs = compare(left, right, dim, cosine)
            out.append(pd.DataFrame({"id": counted["id"], "links": counted["links"], "to": pd.array([None] * len(counted), dtype="Int64")}))
            out.append(pd.DataFrame({"id": pairs[:, 0], "links": np.zeros(len(pairs), np.int64), "to": pd.array(pairs[:, 1], dtype="Int64")}))
        return pd.concat(out) if out else pd.DataFrame(columns=["id", "links", "to"])

    met = stored(dealt.groupBy("g").applyInPandas(meet, "id long, links long, to long"), "links")
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(met.where("to is not null"), "id", "to")
    per = classes.join(links, "id", "left").join(comp, "id", "left")
    per = stored(per.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("comp", "id").alias("component_id")), "per_class")
    named = stored(keyed.select("id", "h1", "h2"), "named").join(per, ["h1", "h2"]).select("id", "n_links", "component_id")
    out = rows.select("id").join(named, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
