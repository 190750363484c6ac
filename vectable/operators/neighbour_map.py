"""K8: a 2-D map that keeps neighbours together.

``neighbour_graph`` finds each row's ``k`` nearest rows (most of them): rows are
put in the order of several random trees, cut into leaves of ``LEAF`` rows, and
compared inside each leaf. Then neighbours of a row are compared with each
other, ``descents`` times, which finds what the trees have cut apart: lists of
``k + 1`` rows fetch their vectors, and blocks of lists keep the best of each row. A tree is a list of planes between pairs of
rows of a bounded sample (``SAMPLE_BYTES``), each through the sample's median;
the sides on which a row lies are its code, and rows in the order of (code,
place along one more direction) come as in a walk over the tree's leaves. The
order is numbered by key ranges (``ranges``), so leaves have a bounded size
whatever the data are, also where a third of all rows are the same vector, and
are the same for any partitions.

``neighbour_map`` starts from the principal components and moves points along
sampled gradients: each is pulled to its neighbours and pushed from points drawn
from all rows. Points are dealt to blocks by their place in the first tree, so
most neighbours are in the block; a round is one join of the graph's edges with
the written positions, and ``STEPS`` steps in each block, in which neighbours of
other blocks stand still. Blocks shift by half from round to round. The driver
sees the sample of vectors and ``PUSHERS`` points a round. Each round is a table
of its own, so a lost executor repeats blocks of one round. The seed decides the
draws: the same rows give the same map up to rounding.

A leaf points at a row from its others only, so equal rows are no hot key. What
is found for a row is merged in ``SALTS`` parts and then as a whole, for a row
that very many lists hold; in joins such a row is a key of many small edges, for
adaptive skew joins to split. A descent sends ``k + 1`` vectors a row, a round
``k + 1`` edges of 24 bytes.

Cases: rows whose vector can't be used (NULL, a NULL or non-finite element,
another length than the most frequent one) have NULL for x and y and no edges;
repeated ids and equal rows are points of their own; a single usable row lies at
(0, 0); an empty table gives none.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.operators import model
from vectable.operators.common import materialize
from vectable.operators.quality import unusable
from vectable.operators.ranges import ranked
from vectable.operators.vectors import vector_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF, SAMPLE, SAMPLE_BYTES = 512, 4096, 16 << 20
BLOCK, STEPS, PUSHERS, PUSHES = 2048, 25, 1024, 8
LISTS, SALTS = 512, 32
#: Rows that a task sorts and numbers: vectors are wide, and trees many.
SORTED = 1 << 14
#: Steps are at most this long, the start's first axis is this wide (standard
#: deviation), and both ends of an edge are pulled by this share.
LONGEST, START, PULL = 4.0, 10.0, 0.5
#: Wider vectors start from drawn places, as their covariance would not fit on the driver.
PCA_WIDTH = 2048


class NeighbourGraph:
    """``points``: number ``n``, the columns asked for as ``c0, c1, ...`` (so that
    no name clashes), and the vector ``v``; ``edges``: for each number ``near``, an array of (squared distance ``d``, number ``n``),
    nearest first. ``rest`` are the rows without a usable vector."""

    def __init__(self, points: DataFrame, edges: DataFrame | None, rest: DataFrame, size: int, width: int):
        self.points, self.edges, self.rest, self.size, self.width = points, edges, rest, size, width


def _planes(sample: np.ndarray, bits: int, seed: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (one more than ``bits``, the last for the order inside a
    code) and the medians of the sample along them."""
    r = np.random.default_rng([seed, tree])
    a, b = r.integers(0, len(sample), (2, bits + 1))
    way = sample[a] - sample[b]
    length = np.sqrt((way * way).sum(axis=1))
    same = length == 0  # equal rows have no plane between them
    way[same] = r.normal(size=(int(same.sum()), sample.shape[1]))
    length[same] = np.sqrt((way[same] ** 2).sum(axis=1))
    way /= length[:, None]
    return way, np.median(sample @ way.T, axis=0)


def _places(planes: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    way, middle = planes
    along = np.round(x @ way.T - middle, 9)
    bits = len(middle) - 1
    code = (along[:, :bits] > 0) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
    return code, along[:, bits]


def _apart(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``a`` and ``b``, the same wherever they are taken."""
    return ((x[a] - x[b]) ** 2).sum(axis=1)


def _best(n: np.ndarray, to: np.ndarray, d: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest different ``to`` of each ``n``, ties by the smaller number."""
    order = np.lexsort((to, d, n))
    n, to, d = n[order], to[order], d[order]
    new = np.ones(len(n), bool)
    new[1:] = (n[1:] != n[:-1]) | (to[1:] != to[:-1])
    n, to, d = n[new], to[new], d[new]
    place = np.arange(len(n)) - np.searchsorted(n, n)
    return pd.DataFrame({"n": n[place < k], "to": to[place < k], "d": d[place < k]})


def nearest_in_leaf(numbers: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """``n, to, d``: the ``k`` nearest others of each row of a leaf."""
    in_order = np.argsort(numbers, kind="stable")
    numbers, x = numbers[in_order], x[in_order]
    centred = x - x.mean(axis=0)
    size = (centred * centred).sum(axis=1)
    dist = size[:, None] + size[None, :] - 2.0 * (centred @ centred.T)
    np.fill_diagonal(dist, np.inf)
    # Some more by the fast formula, then by true differences.
    near = np.argsort(dist, axis=1, kind="stable")[:, : min(k + 8, len(x) - 1)]
    at, to = np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()
    return _best(numbers[at], numbers[to], _apart(x, at, to), k)


def nearest_in_lists(m: np.ndarray, numbers: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """``n, to, d``: of the rows of several lists (row ``i`` is in list ``m[i]``),
    the ``k`` nearest that share a list with each."""
    order = np.lexsort((numbers, m))
    m, numbers, x = m[order], numbers[order], x[order]
    parts = []
    for s in range(1, int(np.bincount(np.unique(m, return_inverse=True)[1]).max())):
        a = np.flatnonzero(m[:-s] == m[s:])
        d = _apart(x, a, a + s)
        parts += [(numbers[a], numbers[a + s], d), (numbers[a + s], numbers[a], d)]
    if not parts:
        return pd.DataFrame({"n": [], "to": [], "d": []}).astype({"n": "int64", "to": "int64"})
    return _best(*(np.concatenate(c) for c in zip(*parts, strict=True)), k)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """``n, near`` of rows ``(n, to, d)``."""
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k).alias("near")
    one = F.slice(F.array_sort(F.collect_set(F.struct("d", F.col("to").alias("n")))), 1, k).alias("near")
    return found.groupBy("n", F.pmod(F.xxhash64("to"), F.lit(SALTS))).agg(one).groupBy("n").agg(best)


def neighbour_graph(df: DataFrame, vec_col: str, keep: Sequence[str], k: int = 15, trees: int = 6, seed: int = 42, descents: int = 2) -> NeighbourGraph:
    """The graph of a frame's rows; ``keep`` are the columns that points carry."""
    spark = df.sparkSession
    rows = materialize(df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.col(vec_col).alias("v")), "map-rows")
    carried = [f"c{i}" for i in range(len(keep))]
    fit = ~unusable("v") & (F.size("v") > 0)
    # The most frequent length (ties: the smaller one): a row for each length there is.
    width = rows.where(fit).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = width["d"] if width else 0
    good = rows.where(fit & (F.size("v") == d))
    rest = rows.where(~(fit & (F.size("v") == d))).select(*carried)
    if not width:
        return NeighbourGraph(good.select(F.lit(0).cast("long").alias("n"), *carried, "v"), None, rest, 0, 0)
    many = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * d)))
    picked = good.orderBy(F.xxhash64("v", F.lit(seed)), *[c for c in carried]).limit(many).select("v").collect()  # SAMPLE_BYTES at most
    sample = np.array([r["v"] for r in picked], dtype=np.float64)
    bits = max(0, min(40, math.ceil(math.log2(max(1, width["count"] / LEAF)))))
    planes = [_planes(sample, bits, seed, t) for t in range(trees)]

    def placed(frame: DataFrame, which: Sequence[int]) -> DataFrame:
        """Each row once for each tree, with its code and place."""
        names = frame.columns
        schema = frame.select("*", F.lit(0).alias("tree"), F.lit(0).cast("long").alias("code"), F.lit(0.0).alias("place")).schema
        shared = spark.sparkContext.broadcast([planes[t] for t in which])  # a few planes each

        def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, at = vector_rows(batch.column(names.index("v")), d)
                kept = batch.take(pa.array(at))
                for t, p in zip(which, shared.value, strict=True):
                    code, place = _places(p, x)
                    yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.full(len(x), t, np.int32)), pa.array(code), pa.array(place)], [*names, "tree", "code", "place"])

        return frame.mapInArrow(fn, schema)

    order = ranked(placed(good, [0]), ["code", "place", *carried], SORTED)
    # In as many files as there are cores: few bytes, but much is worked out from them.
    numbered = order.numbered("n").select("n", *carried, "v").repartition(spark.sparkContext.defaultParallelism, "n")
    points = materialize(numbered, "map-points")
    first = points.select("n", "v", F.lit(0).alias("tree"), F.floor(F.col("n") / LEAF).alias("leaf"))
    if trees > 1 and order.n > LEAF:
        others = ranked(placed(points.select("n", "v"), list(range(1, trees))), ["tree", "code", "place", "n"], SORTED).numbered("at")
        # All trees have as many rows, so a number within the tree is a remainder.
        leaf = F.floor((F.col("at") - (F.col("tree") - 1) * F.lit(order.n)) / LEAF)
        first = first.unionByName(others.select("n", "v", "tree", leaf.alias("leaf")))

    flat = "n long, to long, d double"

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return nearest_in_leaf(pdf["n"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.float64), k)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        return nearest_in_lists(pdf["m"].to_numpy(), pdf["n"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.float64), k)

    edges = materialize(_merged(first.groupBy("tree", "leaf").applyInPandas(compare, flat), k), "map-edges")
    if order.n > LEAF:  # one leaf has compared all
        for _ in range(descents):
            lists = edges.select(F.col("n").alias("m"), F.explode(F.concat(F.array("n"), F.col("near.n"))).alias("n"))
            held = lists.join(points.select("n", "v"), "n").select(F.floor(F.col("m") / LISTS).alias("block"), "m", "n", "v")
            known = edges.select("n", F.inline("near").alias("d", "to")).select("n", "to", "d")
            edges = materialize(_merged(held.groupBy("block").applyInPandas(meet, flat).unionByName(known), k), "map-edges")
    return NeighbourGraph(points, edges, rest, order.n, d)


def _moved(own: np.ndarray, at: np.ndarray, to: np.ndarray, held: np.ndarray, others: np.ndarray, rates: np.ndarray, r: np.random.Generator) -> np.ndarray:
    """Places ``own`` of a block after a step for each rate. Edge ``i`` goes from
    row ``at[i]`` to row ``to[i]``, or, where that is -1, to the place ``held[i]``."""
    y, inside = own.copy(), to >= 0
    edges = np.maximum(np.bincount(at, minlength=len(y)), 1)[:, None]
    end = held.copy()
    for rate in rates:
        end[inside] = y[to[inside]]
        way = y[at] - end
        pull = -2.0 * PULL * way / ((1.0 + (way * way).sum(axis=1))[:, None] * edges[at])
        move = np.stack([np.bincount(at, pull[:, c], len(y)) - np.bincount(to[inside], pull[inside, c], len(y)) for c in (0, 1)], axis=1)
        away = y[:, None, :] - others[r.integers(0, len(others), (len(y), PUSHES))]
        far = (away * away).sum(axis=2)[:, :, None]
        push = np.clip(2.0 * away / ((0.001 + far) * (1.0 + far)), -LONGEST, LONGEST).mean(axis=1)
        y += rate * np.clip(move + push, -LONGEST, LONGEST)
    return y


def start(graph: NeighbourGraph, seed: int) -> DataFrame:
    """``n, x, y``: principal components as wide as ``START``, and a little
    drawn for each point, so that equal rows are not on one place."""
    draw = [(F.pmod(F.xxhash64("n", F.lit(f"{seed}{axis}")), F.lit(2001)) - 1000) / 1e5 for axis in "xy"]
    if not 2 <= graph.width <= PCA_WIDTH:
        return graph.points.select("n", *((100 * START * z).alias(c) for z, c in zip(draw, "xy", strict=True)))
    flat = materialize(model.project_2d(graph.points.select("n", "v", F.lit(0).alias("label")), "v", ["n"], "label"), "map-pca")
    mx, my, sd = flat.agg(F.avg("x"), F.avg("y"), F.stddev_pop("x")).first()
    wide = START / sd if sd and math.isfinite(sd) else 1.0
    return flat.select("n", ((F.col("x") - mx) * wide + draw[0]).alias("x"), ((F.col("y") - my) * wide + draw[1]).alias("y"))


def _round(others: np.ndarray, rates: np.ndarray, seeds: list[int]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The steps of a block, from edges ``n, to, x, y`` with the place of ``to``;
    each point has an edge to itself, which tells its own place."""

    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "to"])
        n, to, xy = pdf["n"].to_numpy(), pdf["to"].to_numpy(), pdf[["x", "y"]].to_numpy()
        mine = n == to
        numbers = n[mine]
        at, end = np.searchsorted(numbers, n[~mine]), np.searchsorted(numbers, to[~mine])
        end = np.where(numbers[np.minimum(end, len(numbers) - 1)] == to[~mine], end, -1)
        y = _moved(xy[mine], at, end, xy[~mine], others, rates, np.random.default_rng([*seeds, int(numbers[0])]))
        return pd.DataFrame({"n": numbers, "x": y[:, 0], "y": y[:, 1]})

    return steps


def layout(graph: NeighbourGraph, rounds: int = 8, seed: int = 42) -> DataFrame:
    """``n, x, y`` of the points of a graph."""
    zero = F.lit(0.0)
    if graph.size < 2:
        return graph.points.select("n", zero.alias("x"), zero.alias("y"))
    steps = rounds * STEPS
    edges = materialize(graph.edges.select("n", F.explode(F.concat(F.array("n"), F.col("near.n"))).alias("to")), "map-links")
    now = materialize(start(graph, seed), "map-start")
    for i in range(rounds):
        drawn = now.orderBy(F.xxhash64("n", F.lit(f"{seed}-{i}")), "n").limit(PUSHERS).select("x", "y").collect()
        others = np.array([tuple(p) for p in drawn])
        rates = 1.0 - np.arange(i * STEPS, (i + 1) * STEPS) / steps
        block = F.floor((F.col("n") + (i % 2) * (BLOCK // 2)) / BLOCK).alias("block")
        linked = edges.join(now.withColumnRenamed("n", "to"), "to").select(block, "n", "to", "x", "y")
        now = materialize(linked.groupBy("block").applyInPandas(_round(others, rates, [seed, i]), "n long, x double, y double"), "map-round")
    return now


def neighbour_map(df: DataFrame, vec_col: str, id_cols: Sequence[str], label_col: str, k: int = 15, trees: int = 6, rounds: int = 8, seed: int = 42) -> DataFrame:
    """K8: ``id_cols, x, y, label_col`` of every row, as ``model.project_2d``
    has them, with neighbours kept together."""
    keep = [*id_cols, label_col]
    graph = neighbour_graph(df, vec_col, keep, k, trees, seed)
    none = F.lit(None).cast("double")
    xy = layout(graph, rounds, seed)
    held = [F.col(f"c{i}").alias(c) for i, c in enumerate(keep)]
    out = graph.points.join(xy, "n").select(*held[:-1], "x", "y", held[-1])
    return out.unionByName(graph.rest.select(*held[:-1], none.alias("x"), none.alias("y"), held[-1]))


def closeness(graph: NeighbourGraph, xy: DataFrame) -> float:
    """How far neighbours are from each other on a map (``n, x, y``), by the mean
    of log distances, as a share of how far drawn pairs are: 1 for a map that
    knows nothing of the graph, smaller for a better one. Two joins of the
    edges; nothing is compared with everything."""
    pairs = graph.edges.select("n", F.posexplode("near.n").alias("i", "to"))
    drawn = F.pmod(F.xxhash64("n", "i"), F.lit(graph.size)).cast("long")
    both = pairs.select("n", "to", F.lit(1).alias("near")).unionByName(pairs.select("n", drawn.alias("to"), F.lit(0).alias("near")).where("n <> to"))
    here, there = xy.toDF("n", "x0", "y0"), xy.toDF("to", "x1", "y1")
    apart = F.log(F.hypot(F.col("x0") - F.col("x1"), F.col("y0") - F.col("y1")) + 1e-6)
    means = {r["near"]: r["m"] for r in both.join(here, "n").join(there, "to").groupBy("near").agg(F.avg(apart).alias("m")).collect()}
    return math.exp(means[1] - means[0])
