"""7. Approximate nearest neighbours: multiprobe p-stable hashing.

Each table hashes a vector by ``HASHES`` Gaussian projections, shifted and cut
into slots of width ``w``; its bucket is the list of slots. A query looks into
its own bucket and into perturbed ones (a step up or down, or more, in some of
the slots). The projection of a neighbour at distance ``r`` differs from the
query's by a normal number of deviation ``r``, so a perturbed bucket's
probability of holding it is a product over the slots; buckets are visited in
the order of this estimate, and a query goes on until the tables together
should hold ``target`` of the neighbours at the distance of its k-th one. That
distance is measured exactly on a bounded sample of queries (``SAMPLE``)
against all rows. Candidates of all tables are merged and reranked exactly.

Nearness is the largest inner product. Rows get one more component that makes
their norms equal, the queries get a 0 there, and then the nearest rows by
distance have the largest products.

The number of slots grows with the logarithm of the rows (``BUCKET_ROWS`` a
bucket), as far as the sample's queries reach the target with ``PROBES``
buckets a table on average; no query is cut off there. Buckets go to shards by
hash, one of over ``SPLIT`` rows in several parts, and a query visits the shards
of its buckets; a shard's answer to it is its ``k`` best. A shard that more than
``QUERY_ROWS`` queries visit is searched in as many blocks of queries, each with
the shard's rows, so that a task holds a block and a shard, and one that no
query visits is not read. Vectors travel in the type of their column. Equal vectors are one row of the index with their ``k`` least
ids: others of them can't be among the ``k`` nearest, ties going to smaller ids.

Cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do null ids; a repeated id is one vector (the least
one); a query with fewer candidates than ``k`` gets all of them; an empty table
gives no rows; vectors of unequal lengths raise an error.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from vectable.llm.blocks import stored
from vectable.llm.vectors import dimension, matrix, usable

TABLES, BUCKET_ROWS, SAMPLE, SPLIT, SHARD_ROWS, SHARDS, PROBES, TARGET = 2, 64, 48, 2048, 8192, 32, 96, 0.97
#: Queries that a block of a shard answers, by a hash of their ids.
QUERY_ROWS = 4096


class Hash:
    """The projections of one table."""

    def __init__(self, dim: int, hashes: int, width: float, seed: int):
        r = np.random.default_rng(seed)
        self.a, self.shift, self.width = r.normal(size=(dim, hashes)), r.uniform(0, width, hashes), width

    def places(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.a + self.shift) / self.width


def bucket_keys(slots: np.ndarray, table: int) -> np.ndarray:
    """One number for each row of slots."""
    h = np.full(len(slots), 0x9E3779B97F4A7C15 * (table + 1) % 2**64, np.uint64)
    for s in slots.astype(np.int64).view(np.uint64).T:
        h = (h ^ s) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _phi(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def probes(place: np.ndarray, width: float, distance: float, target: float, reach: int = 4) -> tuple[np.ndarray, float]:
    """Slot lists in falling order of success, until ``target`` is reached, and
    the estimate that they hold a neighbour at ``distance``."""
    options = []
    for p in place:
        own, at = math.floor(p), p - math.floor(p)
        s = distance / width
        each = []
        for d in range(-reach, reach + 1):
            each.append((_phi((d + 1 - at) / s) - _phi((d - at) / s), own + d))
        options.append(sorted(each, reverse=True))
    # Best first over the ranks of each slot's options; a state has one parent.
    start = (0,) * len(options)
    chance = [[math.log(max(c, 1e-300)) for c, _ in o] for o in options]
    heap = [(-sum(c[0] for c in chance), start, 0)]
    out, got = [], 0.0
    while heap and got < target:
        cost, ranks, last = heapq.heappop(heap)
        out.append([o[r][1] for o, r in zip(options, ranks, strict=True)])
        got += math.exp(-cost)
        for i in range(last, len(ranks)):
            if ranks[i] + 1 < len(options[i]):
                heapq.heappush(heap, (cost + chance[i][ranks[i]] - chance[i][ranks[i] + 1], (*ranks[:i], ranks[i] + 1, *ranks[i + 1 :]), i))
    return np.array(out, dtype=np.int64), got


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties to smaller ids."""
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        ids, scores = ids[at], scores[at]
    at = np.lexsort((ids, -scores))[:k]
    return ids[at], scores[at]


def _numbers(vectors: DataFrame, vec_col: str) -> Column:
    """Single precision as it is (exact in double precision), all else as doubles."""
    single = isinstance(vectors.schema[vec_col].dataType.elementType, FloatType)
    return F.col(vec_col) if single else F.transform(vec_col, lambda v: v.cast("double"))


def nearest(vectors: DataFrame, queries: str, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, target: float = TARGET) -> DataFrame:
    """``query_id, rank, <id_col>, score``: the ``k`` rows of the largest inner
    product found for each row where ``queries`` (SQL) holds, itself left out."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), _numbers(vectors, vec_col).alias("v"), F.coalesce(F.expr(queries), F.lit(False)).alias("asks"))
    rows = rows.where(usable("v")).groupBy("id").agg(F.min(F.struct("v", "asks")).alias("r")).select("id", "r.v", "r.asks")
    dim = dimension(rows, "v")
    held = stored(rows.withColumn("sq", F.aggregate("v", F.lit(0.0), lambda t, v: t + v.cast("double") * v.cast("double"))).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64("v", F.lit(1))), "vectors")
    n, biggest = held.agg(F.count(F.lit(1)), F.max("sq")).first()
    schema = f"query_id long, rank int, `{id_col}` long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    # Equal vectors: their least k + 1 ids (one of them may be the query).
    number = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    least = held.select("id", "h1", "h2").withColumn("i", number).where(F.col("i") <= k + 1)
    members = stored(least.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids")), "members")
    index = stored(held.select("id", "v", "sq").join(members.select("id", "ids"), "id"), "index")
    asking = held.where("asks").select("id", "v", "sq")

    # The k-th distance of a sample of queries, measured against all rows.
    few = asking.orderBy(F.xxhash64("id", F.lit("sample"))).limit(SAMPLE).collect()
    if not few:
        return spark.createDataFrame([], schema)
    q = np.array([r["v"] for r in few])
    own = np.array([r["id"] for r in few])

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            s = q @ matrix(pdf["v"], dim).T
            s[own[:, None] == pdf["id"].to_numpy()[None, :]] = -np.inf
            m = min(k, s.shape[1])
            best = -np.partition(-s, m - 1, axis=1)[:, :m]
            yield pd.DataFrame({"q": np.repeat(np.arange(len(q)), m), "s": best.ravel()})

    best = held.select("id", "v").mapInPandas(measure, "q int, s double").withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s")))).where((F.col("r") <= k) & F.col("s").between(-1e300, 1e300))
    kth = np.array([r["s"] for r in best.groupBy("q").agg(F.min("s").alias("s")).collect()])
    scale = math.sqrt(biggest)
    norm = np.linalg.norm(q, axis=1).mean()
    product = float(np.quantile(kth, 0.25)) if len(kth) else 0.0
    distance = math.sqrt(max(1e-6, norm**2 + biggest - 2 * product)) / scale
    # Slots about as wide as that distance; as many as the rows need, but no more
    # than let a query of the sample reach its target with PROBES buckets on average.
    width = max(1e-3, 1.2 * distance)
    each = 1 - (1 - target) ** (1 / TABLES)
    asked_for = np.column_stack([q, np.zeros(len(q))]) / scale
    hashes, most = 1, int(min(24, max(1, round(math.log(max(2.0, n / BUCKET_ROWS)) / math.log(2.2)))))
    while hashes < most and np.mean([len(probes(p, width, distance, each)[0]) for p in Hash(dim + 1, hashes + 1, width, 17).places(asked_for)]) <= PROBES:
        hashes += 1
    tables = [Hash(dim + 1, hashes, width, 17 + t) for t in range(TABLES)]
    shared = spark.sparkContext.broadcast((tables, scale, biggest, distance, each))

    def extended(pdf: pd.DataFrame, is_query: bool) -> np.ndarray:
        """Vectors over the largest norm, with the component that makes rows' norms equal."""
        _, scale, biggest, _, _ = shared.value
        x = matrix(pdf["v"], dim)
        more = np.zeros(len(x)) if is_query else np.sqrt(np.maximum(0.0, biggest - pdf["sq"].to_numpy()))
        return np.column_stack([x, more]) / scale

    def to_buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x = extended(pdf, False)
            for t, h in enumerate(shared.value[0]):
                yield pd.DataFrame({"key": bucket_keys(np.floor(h.places(x)), t), "id": pdf["id"]})

    def to_probes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, _, _, distance, each = shared.value
        for pdf in frames:
            x = extended(pdf, True)
            for t, h in enumerate(tables):
                places = h.places(x)
                keys = [bucket_keys(probes(p, h.width, distance, each)[0], t) for p in places]
                yield pd.DataFrame({"key": np.concatenate(keys), "query": np.repeat(pdf["id"].to_numpy(), [len(a) for a in keys])})

    placed = stored(index.select("id", "v", "sq").mapInPandas(to_buckets, "key long, id long"), "buckets")
    shards = max(SHARDS, -(-n * TABLES // SHARD_ROWS))
    counts = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    parts = stored(counts.select("key", F.ceil(F.col("n") / F.lit(SPLIT)).cast("int").alias("parts")), "bucket_parts")
    shard = F.pmod(F.xxhash64("key", "part"), F.lit(shards)).cast("int")
    in_shard = placed.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).select(shard.alias("shard"), "key", "id")
    asked = asking.mapInPandas(to_probes, "key long, query long").join(parts, "key").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asked = stored(asked.select(shard.alias("shard"), "key", "query").groupBy("shard", "query").agg(F.collect_set("key").alias("keys")), "probes")
    # Blocks of queries: a row for each shard that is visited, and its rows once a block.
    blocks = stored(asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_ROWS)).cast("int").alias("blocks")), "query_blocks")
    asked = asked.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("query", F.lit("block")), F.col("blocks")).cast("int"))
    asked = asked.select("shard", "block", "query", "keys").join(asking.select(F.col("id").alias("query"), "v"), "query")
    local = stored(in_shard.groupBy("shard", "id").agg(F.collect_list("key").alias("keys")), "sharded").join(blocks, "shard")
    local = local.join(index.select("id", "v", "ids"), "id").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["query", "id", "score"])
        x, out = matrix(left["v"], dim), []
        rows, keys = np.repeat(np.arange(len(left)), left["keys"].map(len)), np.concatenate(left["keys"].tolist())
        order = np.argsort(keys, kind="stable")
        rows, keys = rows[order], keys[order]
        # Members of each row, its own id first.
        many = left["ids"].map(len).to_numpy()
        flat, start = np.concatenate(left["ids"].tolist()), np.concatenate([[0], np.cumsum(many)])
        for query, own_keys, v in zip(right["query"], right["keys"], matrix(right["v"], dim), strict=True):
            own_keys = np.asarray(own_keys)
            a, b = np.searchsorted(keys, own_keys, "left"), np.searchsorted(keys, own_keys, "right")
            met = [rows[i:j] for i, j in zip(a, b, strict=True) if j > i]
            if not met:
                continue
            at = np.unique(np.concatenate(met))
            s = np.einsum("ij,j->i", x[at], v)  # a row's sum does not depend on the rows beside it
            if many[at].max() > 1:
                s = np.repeat(s, many[at])
                ids = np.concatenate([flat[start[i] : start[i + 1]] for i in at])
            else:
                ids = flat[start[at]]
            other = ids != query
            ids, s = _top(ids[other], s[other], k)
            out.append(pd.DataFrame({"query": query, "id": ids, "score": s}))
        return pd.concat(out) if out else pd.DataFrame(columns=["query", "id", "score"])

    found = local.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(search, "query long, id long, score double")
    # Tables are merged: a row that several of them found counts once.
    merged = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(id_col), "score")
