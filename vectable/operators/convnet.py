"""K1, K6: a convolutional classifier, trained in data-parallel mini-batches.

The network is convolution, pooling, convolution, pooling, dense, dense: 3 x 3
filters and 2 x 2 maxima with ``relu`` between, and a softmax over the classes.
Images are rows of a vector column (height x width x channels, row-major).

Training rows are dealt to mini-batches once, by a seeded order, and written as
a table with a folder for each batch. A step reads its folder only: every task
adds up the gradient of its rows in NumPy, the tasks' gradients are added up on
the executors in two levels, and one sum comes to the driver,
which holds the weights and the optimiser's two moments, nothing of the data.
The sum over a batch is the same for any number of partitions, up to rounding.
Batches come in a new seeded order in each epoch. A step is a job of its own
over written tables, so a lost executor repeats some tasks of one step, and a
fit can go on from a saved state (``save_fit``, ``load_fit``) with the same
result as without a break.

Loss and accuracy of an epoch are those of its batches as they were trained on;
with a validation frame, those after the epoch are measured on it as well.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from vectable.operators import batching
from vectable.operators.common import computed_once
from vectable.operators.quality import EmptyInputError, unusable
from vectable.operators.vectors import vector_rows
from vectable.session import scratch_path

FILTER, POOL, FAN = 3, 2, 16
CHUNK_BYTES = 64 << 20  # of windows in memory at a time
MAX_STEPS = 10_000
LEAST = 1e-300

HISTORY = "epoch int, accuracy double, loss double, val_accuracy double, val_loss double"


@dataclass(frozen=True)
class Network:
    """The shape of a network. ``same`` pads images so that convolutions keep their size."""

    height: int
    width: int
    channels: int
    classes: int
    filters: tuple[int, int] = (32, 64)
    hidden: int = 64
    same: bool = False

    def shapes(self) -> list[tuple[int, ...]]:
        """Of the weights: for each layer, a matrix and a bias."""
        h, w, c, out = self.height, self.width, self.channels, []
        for f in self.filters:
            out += [(FILTER * FILTER * c, f), (f,)]
            less = 0 if self.same else FILTER - 1
            h, w, c = (h - less) // POOL, (w - less) // POOL, f
        if min(h, w) < 1:
            raise ValueError(f"images of {self.height} x {self.width} are too small for this network")
        return [*out, (h * w * c, self.hidden), (self.hidden,), (self.hidden, self.classes), (self.classes,)]

    @property
    def size(self) -> int:
        return sum(math.prod(s) for s in self.shapes())

    @property
    def inputs(self) -> int:
        return self.height * self.width * self.channels

    def start(self, seed: int = 42) -> np.ndarray:
        """Uniform weights as wide as their layers ask for (Glorot), biases 0."""
        r, parts = np.random.default_rng(seed), []
        for s in self.shapes():
            wide = math.sqrt(6 / (s[0] + s[-1])) if len(s) == 2 else 0.0
            parts.append(r.uniform(-wide, wide, s).ravel())
        return np.concatenate(parts)

    def layers(self, weights: np.ndarray) -> list[np.ndarray]:
        shapes = self.shapes()
        ends = np.cumsum([math.prod(s) for s in shapes])
        return [x.reshape(s) for x, s in zip(np.split(weights, ends[:-1]), shapes, strict=True)]

    def chunk(self) -> int:
        """Images at a time."""
        widest = max(self.height * self.width * FILTER * FILTER * c for c in (self.channels, self.filters[0] // POOL**2 + 1))
        return max(1, CHUNK_BYTES // (8 * widest))

    def forward(self, weights: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Class probabilities, the values before the last layer, and what the way back needs."""
        w = self.layers(weights)
        a, back = x.reshape(-1, self.height, self.width, self.channels), []
        for i in (0, 2):
            if self.same:
                a = np.pad(a, ((0, 0), (1, 1), (1, 1), (0, 0)))
            seen = np.lib.stride_tricks.sliding_window_view(a, (FILTER, FILTER), axis=(1, 2))
            n, h, wd = seen.shape[:3]
            windows = seen.transpose(0, 1, 2, 4, 5, 3).reshape(n * h * wd, -1)
            z = np.maximum(windows @ w[i] + w[i + 1], 0).reshape(n, h, wd, -1)
            h2, w2 = h // POOL, wd // POOL
            cells = z[:, : h2 * POOL, : w2 * POOL].reshape(n, h2, POOL, w2, POOL, -1).transpose(0, 1, 3, 5, 2, 4).reshape(n, h2, w2, -1, POOL * POOL)
            best = cells.argmax(axis=4)  # the first of equal ones
            back.append((a.shape, windows, z, best))
            a = np.take_along_axis(cells, best[..., None], axis=4)[..., 0]
        flat = a.reshape(len(a), -1)
        hidden = np.maximum(flat @ w[4] + w[5], 0)
        score = hidden @ w[6] + w[7]
        p = np.exp(score - score.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), hidden, [*back, flat, a.shape]

    def gradient(self, weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, int]:
        """Of the summed cross-entropy of some images, with that sum and how many were right."""
        w = self.layers(weights)
        p, hidden, (*back, flat, shape) = self.forward(weights, x)
        own = np.arange(len(y))
        loss, right = float(-np.log(np.maximum(p[own, y], LEAST)).sum()), int((p.argmax(axis=1) == y).sum())
        d = p.copy()
        d[own, y] -= 1
        out = [hidden.T @ d, d.sum(axis=0)]
        d = (d @ w[6].T) * (hidden > 0)
        out = [flat.T @ d, d.sum(axis=0), *out]
        d = (d @ w[4].T).reshape(shape)
        for i, (size, windows, z, best) in zip((2, 0), reversed(back), strict=True):
            n, h, wd, f = z.shape
            h2, w2 = d.shape[1:3]
            cells = np.zeros((*best.shape, POOL * POOL))
            np.put_along_axis(cells, best[..., None], d[..., None], axis=4)
            dz = np.zeros_like(z)
            dz[:, : h2 * POOL, : w2 * POOL] = cells.reshape(n, h2, w2, f, POOL, POOL).transpose(0, 1, 4, 2, 5, 3).reshape(n, h2 * POOL, w2 * POOL, f)
            dz = (dz * (z > 0)).reshape(-1, f)
            out = [windows.T @ dz, dz.sum(axis=0), *out]
            if i:
                d_windows = (dz @ w[i].T).reshape(n, h, wd, FILTER, FILTER, -1)
                d = np.zeros(size)
                for r in range(FILTER):
                    for c in range(FILTER):
                        d[:, r : r + h, c : c + wd] += d_windows[:, :, :, r, c]
                if self.same:
                    d = d[:, 1:-1, 1:-1]
        return np.concatenate([g.ravel() for g in out]), loss, right


@dataclass
class Fit:
    """Weights, the optimiser's moments, and the history so far."""

    network: Network
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int = 0
    history: list[tuple] = field(default_factory=list)


def new_fit(network: Network, seed: int = 42, weights: np.ndarray | None = None) -> Fit:
    start = network.start(seed) if weights is None else np.asarray(weights, np.float64)
    return Fit(network, start, np.zeros(network.size), np.zeros(network.size))


def _summed(df: DataFrame) -> np.ndarray | None:
    """The sum of all rows of ``g binary`` (64-bit numbers), added up on the
    executors by ``FAN`` tasks and then by one."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for g in batch.column(0):
                x = np.frombuffer(g.as_py(), np.float64)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])

    for tasks in (FAN, 1):
        df = df.repartition(tasks).mapInArrow(fn, "g binary")
    row = df.first()
    return None if row is None else np.frombuffer(row["g"], np.float64)


def _pass(rows: DataFrame, network: Network, weights: np.ndarray, label_col: str, vec_col: str, gradients: bool) -> np.ndarray | None:
    """Gradient (if asked for), summed loss, right ones and rows of a frame, as one vector."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, step = np.zeros((network.size if gradients else 0) + 3), network.chunk()
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                x, at = vector_rows(part.column(1), network.inputs)
                y = part.column(0).to_numpy(zero_copy_only=False)[at].astype(np.int64)
                if not len(y):
                    continue
                if gradients:
                    g, loss, right = network.gradient(shared.value, x, y)
                    total[:-3] += g
                else:
                    p, _, _ = network.forward(shared.value, x)
                    loss, right = -np.log(np.maximum(p[np.arange(len(y)), y], LEAST)).sum(), (p.argmax(axis=1) == y).sum()
                total[-3:] += loss, right, len(y)
        if total[-1]:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])

    out = rows.select(F.col(label_col).cast("long"), vec_col)
    try:
        return _summed(out.mapInArrow(fn, "g binary"))
    finally:
        shared.unpersist()


def usable_rows(df: DataFrame, network: Network, label_col: str, vec_col: str) -> DataFrame:
    """Rows to learn from: a class of the network and a usable vector of its size."""
    rows = computed_once(df)
    return rows.where((F.col(label_col) >= 0) & (F.col(label_col) < network.classes) & ~unusable(vec_col, network.inputs))


def dealt(train: DataFrame, network: Network, id_col: str, label_col: str, vec_col: str, batch_size: int, seed: int) -> DataFrame:
    """The training rows as a table with a folder for each mini-batch (``step``)."""
    rows = usable_rows(train.select(id_col, label_col, vec_col), network, label_col, vec_col)
    n = rows.count()
    if not n:
        raise EmptyInputError("no training rows")
    if -(-n // batch_size) > MAX_STEPS:
        raise ValueError(f"{n} rows in batches of {batch_size} are over {MAX_STEPS} steps an epoch; take larger batches")
    batches = batching.mini_batches(rows, id_col, seed, batch_size, batch_col="step")
    path = scratch_path(train.sparkSession, "mini-batches")
    # Rows of a batch go to a few files each, as many as keep all cores busy in a step.
    salt = F.pmod(F.xxhash64(F.col(id_col)), F.lit(max(1, min(64, batch_size // 256))))
    batches.withColumn("__salt", salt).repartition("step", "__salt").select("step", label_col, vec_col).write.partitionBy("step").parquet(path)
    schema = batches.select(label_col, vec_col, F.col("step").cast("long")).schema
    return train.sparkSession.read.schema(schema).parquet(path)


def step_gradient(table: DataFrame, step: int, network: Network, weights: np.ndarray, label_col: str, vec_col: str) -> np.ndarray:
    """Gradient, loss, right ones and rows of one mini-batch: its sums."""
    return _pass(table.where(F.col("step") == step), network, weights, label_col, vec_col, True)


def fit(
    train: DataFrame,
    id_col: str,
    label_col: str,
    vec_col: str,
    state: Fit,
    epochs: int = 10,
    batch_size: int = 32,
    seed: int = 42,
    rate: float = 1e-3,
    validation: DataFrame | None = None,
    table: DataFrame | None = None,
) -> Fit:
    """K1: go on from ``state`` until it has ``epochs`` epochs (Adam). ``table``
    is of ``dealt``; without it the rows are dealt here."""
    net = state.network
    if table is None:
        table = dealt(train, net, id_col, label_col, vec_col, batch_size, seed)
    steps = [r["step"] for r in table.select("step").distinct().collect()]  # MAX_STEPS at most
    weights, first, second, done, history = state.weights, state.first, state.second, state.steps, list(state.history)
    held_out = None if validation is None else usable_rows(validation, net, label_col, vec_col)
    for epoch in range(len(history) + 1, epochs + 1):
        sums = np.zeros(3)
        for step in np.random.default_rng([seed, epoch]).permutation(sorted(steps)):
            total = step_gradient(table, int(step), net, weights, label_col, vec_col)
            g, done = total[:-3] / total[-1], done + 1
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            weights = weights - rate * (first / (1 - 0.9**done)) / (np.sqrt(second / (1 - 0.999**done)) + 1e-7)
            sums += total[-3:]
        told = None if held_out is None else _pass(held_out, net, weights, label_col, vec_col, False)
        val = (None, None) if told is None else (float(told[1] / told[2]), float(told[0] / told[2]))
        history.append((epoch, float(sums[1] / sums[2]), float(sums[0] / sums[2]), *val))
    return Fit(net, weights, first, second, done, history)


def history_frame(spark: SparkSession, state: Fit) -> DataFrame:
    """K6: accuracy and loss of each epoch, and on the validation rows after it."""
    return spark.createDataFrame(state.history, HISTORY)


def predict(state: Fit, df: DataFrame, vec_col: str, pred_col: str = "prediction", hidden_col: str | None = None) -> DataFrame:
    """K2, K3, K5, K7: the rows with ``prediction`` (first maximum) and
    ``probability``, and with ``hidden_col`` the values before the last layer.
    Rows whose vector cannot be used have NULLs."""
    network = state.network
    shared = df.sparkSession.sparkContext.broadcast(state.weights)
    arrays = ArrayType(DoubleType())
    new = [StructField(pred_col, IntegerType()), StructField("probability", arrays)] + ([StructField(hidden_col, arrays)] if hidden_col else [])
    kept = [f for f in df.schema.fields if f.name not in {x.name for x in new}]
    types = [to_arrow_schema(StructType(new)).field(i).type for i in range(len(new))]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, network.chunk()):
                batch = whole.slice(i, network.chunk())
                x, at = vector_rows(batch.column(vec_col), network.inputs)
                out: list[list] = [[None] * batch.num_rows for _ in new]
                if len(at):
                    p, hidden, _ = network.forward(shared.value, x)
                    for column, values in zip(out, (p.argmax(axis=1).tolist(), list(p), list(hidden)), strict=False):
                        for r, v in zip(at, values, strict=True):
                            column[r] = v
                arrays = [batch.column(f.name) for f in kept] + [pa.array(v, t) for v, t in zip(out, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in kept), *(f.name for f in new)])

    return df.mapInArrow(fn, StructType([*kept, *new]))


# ---------------------------------------------------------------- S10, S11

_STATE = "height int, width int, channels int, classes int, filters array<int>, hidden int, same boolean, steps int, history string, weights binary, first binary, second binary"


def save_fit(spark: SparkSession, state: Fit, path: str) -> None:
    """The whole state as a one-row table."""
    n = state.network
    row = (n.height, n.width, n.channels, n.classes, list(n.filters), n.hidden, n.same, state.steps, json.dumps(state.history))
    vectors = [bytearray(x.tobytes()) for x in (state.weights, state.first, state.second)]
    spark.createDataFrame([(*row, *vectors)], _STATE).write.mode("overwrite").parquet(path)


def load_fit(spark: SparkSession, path: str) -> Fit:
    """S11."""
    r = spark.read.schema(_STATE).parquet(path).first()
    net = Network(r["height"], r["width"], r["channels"], r["classes"], tuple(r["filters"]), r["hidden"], r["same"])
    vectors: Sequence[np.ndarray] = [np.frombuffer(r[c], np.float64) for c in ("weights", "first", "second")]
    return Fit(net, *vectors, r["steps"], [tuple(h) for h in json.loads(r["history"])])
