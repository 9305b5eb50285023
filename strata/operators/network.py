"""Feed-forward network (M3) and its continual training (M7).

ReLU hidden layers, one logistic output, log loss with an L2 penalty
``alpha / 2 * |W|^2`` divided by the rows of a batch, Adam, Glorot-uniform
start. An epoch goes through the rows in a permutation of its own, the order
of a keyed 64-bit hash of the row and the epoch, in batches of
``batch_rows``; every batch is one update, whatever the number of rows.

Two ways make the updates of an epoch:

* ``batch_rows`` below ``PARALLEL_ROWS``: a batch is too small to be worth a
  job. The permutation is cut into slices of about ``SLICE_ROWS`` rows; a task
  takes the batches of one slice in order and returns the weights and the rows
  that fill no batch, which open the next slice. Updates depend on one another,
  so slices come one after the other, and a task streams. Everything else is
  taken out of that chain: while an epoch runs, the other cores sort the next
  one and pack its rows (``Epochs``).
* larger batches: a batch is one range of the permutation. Every partition
  sums the gradients of its rows, the sums are added up as a tree, and the
  driver takes the step.

Only weights, optimiser state (three numbers a weight) and less than one small
batch of rows pass through the driver. After each epoch of ``train`` the
accuracy on the held-out share decides: training stops when it has not risen
by ``tol`` over the best for more than ``patience`` epochs; the best weights
are kept. The optimiser state stays with the model, and ``fine_tune`` goes on
from it.
"""

from __future__ import annotations

import io
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.preprocess import class_allocation
from strata.operators.ranking import exact_row_number, md5_bucket
from strata.session import materialize, remove_stage

SLICE_ROWS = 1_000_000
PARALLEL_ROWS = 50_000
DEALERS = 32               # ranges of one slice that are sorted and packed side by side
PACKED_BYTES = 6_400       # values of a packed block: 10,000 of them, an Arrow batch, take 64 MB
AHEAD_BYTES = 16_000_000   # values of the smallest epoch that is sorted ahead
TREE_WIDTH = 32
# Defaults of the reference's network and of its optimiser.
ALPHA, RATE, BETA1, BETA2, EPSILON = 1e-4, 1e-3, 0.9, 0.999, 1e-8
HELD_OUT, TOL, PATIENCE = 0.1, 1e-4, 10


def layer_shapes(sizes: list[int]) -> list[tuple[int, ...]]:
    return [s for a, b in zip(sizes, sizes[1:]) for s in ((a, b), (b,))]


def unflatten(flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Weights and offsets of every layer as views of the flat vector."""
    out, at = [], 0
    for shape in layer_shapes(sizes):
        n = math.prod(shape)
        out.append(flat[at:at + n].reshape(shape))
        at += n
    return out


def first_weights(sizes: list[int], seed: int) -> np.ndarray:
    """Glorot-uniform; the logistic output layer has the narrower bound."""
    rng = np.random.default_rng(seed)
    parts = []
    for k, (a, b) in enumerate(zip(sizes, sizes[1:])):
        bound = math.sqrt((2.0 if k == len(sizes) - 2 else 6.0) / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def forward(layers: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """Input and activations of every layer; the last is P(label = 1)."""
    acts = [x]
    for k in range(0, len(layers), 2):
        z = acts[-1] @ layers[k]
        z += layers[k + 1]
        acts.append(np.maximum(z, 0, out=z) if k < len(layers) - 2 else 1 / (1 + np.exp(-np.clip(z, -700, 700))))
    return acts


def outputs(flat: np.ndarray, sizes: list[int], x: np.ndarray) -> list[np.ndarray]:
    """``forward`` by flat weights."""
    return forward(unflatten(flat, sizes), x)


def gradient_into(into: list[np.ndarray], layers: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> float:
    """Summed log loss of the rows; its gradient (no penalty, not divided) is
    written into the views of every layer."""
    acts = forward(layers, x)
    p = np.clip(acts[-1][:, 0], 1e-15, 1 - 1e-15)
    loss = -float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    delta = acts[-1] - y[:, None]
    for k in range(len(layers) - 2, -1, -2):
        below = acts[k // 2]
        np.matmul(below.T, delta, out=into[k])
        np.sum(delta, 0, out=into[k + 1])
        if k:
            delta = delta @ layers[k].T
            delta *= below > 0
    return loss


def loss_and_gradient(flat: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed log loss of the rows and its gradient (no penalty, not divided)."""
    gradient = np.empty(len(flat))
    return gradient_into(unflatten(gradient, sizes), unflatten(flat, sizes), x, y), gradient


@dataclass
class State:
    """Flat weights and Adam's moments after ``t`` updates."""
    weights: np.ndarray
    m: np.ndarray
    v: np.ndarray
    t: int = 0

    @staticmethod
    def fresh(weights: np.ndarray) -> "State":
        return State(weights.copy(), np.zeros_like(weights), np.zeros_like(weights))

    def own(self) -> "State":
        """A copy that may be changed in place."""
        return State(self.weights.copy(), self.m.copy(), self.v.copy(), self.t)

    def step(self, sizes: list[int], gradient: np.ndarray, n: int, rate: float, alpha: float) -> None:
        """One update, in place, from the summed gradient of n rows."""
        g = np.zeros_like(self.weights)
        for to, w in zip(unflatten(g, sizes)[::2], unflatten(self.weights, sizes)[::2]):
            np.multiply(w, alpha, out=to)
        g += gradient
        g /= n
        self.t += 1
        self.m *= BETA1
        move = g * (1 - BETA1)
        self.m += move
        self.v *= BETA2
        np.multiply(g, 1 - BETA2, out=move)
        move *= g
        self.v += move
        now = rate * math.sqrt(1 - BETA2 ** self.t) / (1 - BETA1 ** self.t)
        np.sqrt(self.v, out=g)
        g += EPSILON
        np.multiply(self.m, now, out=move)
        move /= g
        self.weights -= move

    def penalty(self, sizes: list[int], alpha: float) -> float:
        return 0.5 * alpha * sum(float((w * w).sum()) for w in unflatten(self.weights, sizes)[::2])

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, weights=self.weights, m=self.m, v=self.v, t=self.t)
        return out.getvalue()

    @staticmethod
    def unpack(raw: bytes) -> "State":
        got = np.load(io.BytesIO(raw))
        return State(got["weights"], got["m"], got["v"], int(got["t"]))


@dataclass
class NetworkModel:
    """A network with its optimiser state; ``transform`` adds ``probability``
    (of both classes, as Spark ML does) and ``prediction``."""
    sizes: list[int]
    state: State
    history: list[dict] = field(default_factory=list)
    features_col: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        sizes, weights = self.sizes, self.state.weights

        @F.pandas_udf("double")
        def score(col):
            import pandas as pd
            if not len(col):
                return pd.Series([], dtype=float)
            return pd.Series(outputs(weights, sizes, np.vstack(col.to_numpy()))[-1][:, 0])

        p = F.col("_p")
        return (df.withColumn("_p", score(_as_array(df, self.features_col)))
                .withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p > 0.5).cast("double")).drop("_p"))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of Parquet: layer sizes, weights and optimiser state."""
        spark.createDataFrame([(self.sizes, bytearray(self.state.pack()))], "sizes array<int>, state binary") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "NetworkModel":
        row = spark.read.parquet(path).first()
        return NetworkModel(list(row["sizes"]), State.unpack(bytes(row["state"])))


def _as_array(df: DataFrame, col: str):
    vector = isinstance(df.schema[col].dataType, VectorUDT)
    return vector_to_array(F.col(col)) if vector else F.col(col).cast("array<double>")


def training_rows(df: DataFrame, label: str = "label", features_col: str = "features",
                  key_cols: list[str] | None = None) -> DataFrame:
    """(key, x, y), written: ``key`` is a hash of the key columns or, without
    any, of the row's features and label."""
    x = _as_array(df, features_col)
    key = F.xxhash64(*([F.col(c) for c in key_cols] if key_cols else [x, F.col(label).cast("double")]))
    return materialize(df.select(key.alias("key"), x.alias("x"), F.col(label).cast("double").alias("y")), "net-rows")


def place_in_epoch(epoch: int, seed: int):
    """Sort key of a row in the epoch's permutation."""
    return F.xxhash64("key", F.lit(seed), F.lit(epoch))


def _slice_of(place, slices: int):
    """Number of the range of 64-bit hashes that holds the place."""
    high = F.shiftright(place, 32) + F.lit(1 << 31)              # 0 to 2^32 - 1
    return F.shiftright(high * F.lit(slices), 32).cast("int")


def _slices(n: int, batch_rows: int, slice_rows: int, parallel_rows: int) -> int:
    return max(1, -(-n // (max(slice_rows, batch_rows) if batch_rows < parallel_rows else batch_rows)))


def _dealt(rows: DataFrame, epoch: int, seed: int, slices: int) -> DataFrame:
    """Rows with their place; several slices are written apart, one read each."""
    out = rows.withColumn("place", place_in_epoch(epoch, seed))
    if slices == 1:
        return out.withColumn("slice", F.lit(0))
    out = out.withColumn("slice", _slice_of(F.col("place"), slices))
    # up to DEALERS tasks write a slice side by side
    return materialize(out.repartition("slice", F.pmod("key", F.lit(DEALERS))), "net-epoch", partition_by=["slice"])


PACKED = "slice int, range int, at int, x binary, y binary"


def _packed(rows: DataFrame, epoch: int, seed: int, slices: int, width: int) -> DataFrame:
    """The epoch's rows in order, written as blocks of rows that end in a one:
    every slice is cut into ranges of places, which tasks sort and pack side by
    side."""
    size = max(1, PACKED_BYTES // (8 * width))

    def task(batches):
        done = {}                                                          # blocks of a range so far
        for b in batches:
            table = pa.table(b)
            x, y = _matrix(table, width)
            x = _ends_in_one(x)
            part = np.asarray(table.column("part"))
            ends = np.flatnonzero(np.diff(part)) + 1
            for lo, hi in zip([0, *ends], [*ends, len(part)]):
                k = int(part[lo]) if hi > lo else 0
                starts = np.arange(lo, hi, size)
                first = done.get(k, 0)
                done[k] = first + len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(starts), k // DEALERS), pa.int32()), pa.array(np.full(len(starts), k), pa.int32()),
                     pa.array(np.arange(first, done[k]), pa.int32()),
                     pa.array([x[i:min(i + size, hi)].tobytes() for i in starts], pa.binary()),
                     pa.array([y[i:min(i + size, hi)].tobytes() for i in starts], pa.binary())],
                    ["slice", "range", "at", "x", "y"])

    out = rows.withColumn("place", place_in_epoch(epoch, seed)) \
        .withColumn("part", _slice_of(F.col("place"), slices * DEALERS))
    out = out.repartition(slices * DEALERS, "part").sortWithinPartitions("part", "place", "key", "y", "x")
    return materialize(out.select("part", "x", "y").mapInArrow(task, PACKED), "net-epoch", partition_by=["slice"])


class Epochs:
    """Orders of the rows of epoch after epoch: while one is taken, a second
    thread has the next one sorted and packed. Small epochs are sorted by the
    task that takes them."""

    def __init__(self, rows: DataFrame, n: int, epochs: int, seed: int, width: int, batch_rows: int, slice_rows: int,
                 parallel_rows: int):
        self.slices = _slices(n, batch_rows, slice_rows, parallel_rows)
        self.rows, self.epochs, self.seed, self.width = rows, epochs, seed, width
        self.ahead = batch_rows < parallel_rows and 8 * n * width >= AHEAD_BYTES
        self.pool, self.next, self.taken = ThreadPoolExecutor(1), None, None

    def __enter__(self) -> "Epochs":
        return self

    def _deal(self, epoch: int):
        return self.pool.submit(_packed, self.rows, epoch, self.seed, self.slices, self.width)

    def take(self, epoch: int) -> DataFrame | None:
        """The packed epoch, None if it is small."""
        if not self.ahead:
            return None
        self._drop()
        self.taken = (self.next or self._deal(epoch)).result()
        self.next = self._deal(epoch + 1) if epoch + 1 < self.epochs else None
        return self.taken

    def _drop(self) -> None:
        if self.taken is not None:
            remove_stage(self.taken)
            self.taken = None

    def __exit__(self, *_) -> None:
        self._drop()
        if self.next is not None and self.next.exception() is None:
            remove_stage(self.next.result())
        self.pool.shutdown()


def _matrix(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.concatenate([np.asarray(c.flatten(), np.float64) for c in table.column("x").chunks] or [np.zeros(0)])
    return x.reshape(-1, width), np.asarray(table.column("y"), np.float64)


STREAMED = "state binary, loss double, x array<double>, y array<double>"


class Updates:
    """Updates of a state by batches of up to ``batch_rows`` rows, in buffers
    that are made once. A layer's offsets lie behind its weights in the flat
    vector and take part in the same products, for inputs that end in a one;
    moments are kept without their constant factors."""

    def __init__(self, state: State, sizes: list[int], batch_rows: int, rate: float, alpha: float):
        self.sizes, self.rows, self.rate, self.t = sizes, batch_rows, rate, state.t
        self.weights = state.weights.copy()
        self.m_unit, self.v_unit = (1 - BETA1) / batch_rows, (1 - BETA2) / batch_rows ** 2
        self.m, self.v = state.m / self.m_unit, state.v / self.v_unit
        self.gradient, self.spare, self.decay = (np.zeros_like(self.weights) for _ in range(3))
        for w in unflatten(self.decay, sizes)[::2]:
            w[:] = alpha
        self.layers, self.into, at = [], [], 0
        for a, b in zip(sizes, sizes[1:]):
            to = at + (a + 1) * b
            self.layers.append(self.weights[at:to].reshape(a + 1, b))
            self.into.append(self.gradient[at:to].reshape(a + 1, b))
            at = to
        padded = [np.zeros((batch_rows, -(-(b + 1) // 8) * 8)) for b in sizes[1:]]
        self.acts = [p[:, :b + 1] for p, b in zip(padded, sizes[1:])]
        for p in self.acts:
            p[:, -1] = 1.0
        self.deltas = [np.empty((batch_rows, b)) for b in sizes[1:]]
        self.masks = [np.empty((batch_rows, b)) for b in sizes[1:-1]]

    def update(self, x: np.ndarray, y: np.ndarray) -> float:
        """One update by rows that end in a one: summed log loss and penalty before it."""
        n, last = len(y), len(self.layers) - 1
        acts = [x] + [a[:n] for a in self.acts]
        for k, w in enumerate(self.layers):
            z = acts[k + 1][:, :-1]
            np.matmul(acts[k], w, out=z)
            if k < last:
                np.maximum(z, 0, out=z)
        p = 1 / (1 + np.exp(-np.minimum(np.maximum(acts[-1][:, 0], -700), 700)))
        delta = self.deltas[last][:n]
        np.subtract(p, y, out=delta[:, 0])
        p = np.minimum(np.maximum(p, 1e-15), 1 - 1e-15)
        loss = -float(y @ np.log(p) + (1 - y) @ np.log(1 - p))
        for k in range(last, -1, -1):
            np.matmul(acts[k].T, delta, out=self.into[k])
            if k:
                below, mask = self.deltas[k - 1][:n], self.masks[k - 1][:n]
                np.matmul(delta, self.layers[k][:-1].T, out=below)
                np.minimum(acts[k][:, :-1], 1, out=mask)                  # one above zero, else zero
                np.ceil(mask, out=mask)
                below *= mask
                delta = below
        return loss + self._step(n)

    def _step(self, n: int) -> float:
        g, spare = self.gradient, self.spare
        np.multiply(self.weights, self.decay, out=spare)
        penalty = 0.5 * float(spare @ self.weights)
        g += spare
        if n != self.rows:
            g *= self.rows / n
        self.t += 1
        self.m *= BETA1
        self.m += g
        self.v *= BETA2
        g *= g
        self.v += g
        np.sqrt(self.v, out=spare)
        root = math.sqrt(self.v_unit)
        spare += EPSILON / root
        np.divide(self.m, spare, out=spare)
        spare *= self.rate * math.sqrt(1 - BETA2 ** self.t) / (1 - BETA1 ** self.t) * self.m_unit / root
        self.weights -= spare
        return penalty

    def state(self) -> State:
        return State(self.weights.copy(), self.m * self.m_unit, self.v * self.v_unit, self.t)


def _ends_in_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def _unpacked(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of packed blocks, in their order: views of the table's buffers."""
    out = []
    for name in ("x", "y"):
        views = []
        for c in table.column(name).chunks:
            kind = np.int64 if pa.types.is_large_binary(c.type) else np.int32
            ends = np.frombuffer(c.buffers()[1], kind)[c.offset:c.offset + len(c) + 1]
            if len(c) and ends[-1] > ends[0]:
                views.append(np.frombuffer(c.buffers()[2], np.float64, (ends[-1] - ends[0]) // 8, ends[0]))
        out.append(views[0] if len(views) == 1 else np.concatenate(views or [np.zeros(0)]))
    return out[0].reshape(-1, width + 1), out[1]


def _ones_matrix(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    x, y = _matrix(table, width)
    return _ends_in_one(x), y


def _stream(state: State, sizes: list[int], batch_rows: int, rate: float, alpha: float,
            left_x: np.ndarray, left_y: np.ndarray, last: bool, packed: bool):
    """Task: the batches of one sorted slice, after the rows left over."""
    width = sizes[0]

    def task(batches):
        x, y, loss, now = _ends_in_one(left_x), left_y, 0.0, Updates(state, sizes, batch_rows, rate, alpha)
        for b in batches:
            more_x, more_y = (_unpacked if packed else _ones_matrix)(pa.table(b), width)
            at = 0
            if len(y):                                                     # fill the open batch
                at = min(batch_rows - len(y), len(more_y))
                x, y = np.concatenate([x, more_x[:at]]), np.concatenate([y, more_y[:at]])
                if len(y) < batch_rows:
                    continue
                loss += now.update(x, y)
            end = at + (len(more_y) - at) // batch_rows * batch_rows
            for at in range(at, end, batch_rows):
                loss += now.update(more_x[at:at + batch_rows], more_y[at:at + batch_rows])
            x, y = more_x[end:].copy(), more_y[end:].copy()
        if last and len(y):
            loss += now.update(x, y)
            x, y = x[:0], y[:0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([now.state().pack()], pa.binary()), pa.array([loss]),
             pa.array([x[:, :-1].ravel()], pa.list_(pa.float64())), pa.array([y], pa.list_(pa.float64()))],
            ["state", "loss", "x", "y"])

    return task


PARTIAL = "part int, loss double, rows long, gradient binary"


def tree_sum(parts: DataFrame) -> tuple[float, int, np.ndarray]:
    """(loss, rows, gradient) summed over a written table of partial sums:
    groups of ``TREE_WIDTH`` parts at a time, the last group by the driver."""
    def add(table: pa.Table) -> pa.Table:
        g = np.sum([np.frombuffer(v, np.float64) for v in table.column("gradient").to_pylist()], axis=0)
        return pa.table({"part": table.column("part").slice(0, 1), "loss": [sum(table.column("loss").to_pylist())],
                         "rows": [sum(table.column("rows").to_pylist())], "gradient": pa.array([g.tobytes()], pa.binary())})

    left = parts.count()
    parts = parts.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(left)).cast("int")) if left > TREE_WIDTH else parts
    while left > TREE_WIDTH:
        left = -(-left // TREE_WIDTH)
        parts = parts.withColumn("part", (F.col("part") % left).cast("int")).groupBy("part").applyInArrow(add, PARTIAL)
    total = add(parts.toArrow())
    return total["loss"][0].as_py(), total["rows"][0].as_py(), np.frombuffer(total["gradient"][0].as_py(), np.float64)


def _partials(rows: DataFrame, state: State, sizes: list[int], block: int = 4096) -> DataFrame:
    """One partial sum of loss and gradient per partition that has rows."""
    weights, width = state.weights, sizes[0]

    def task(batches):
        loss, n, g = 0.0, 0, np.zeros_like(weights)
        for b in batches:
            x, y = _matrix(pa.table(b), width)
            for at in range(0, len(y), block):
                got, more = loss_and_gradient(weights, sizes, x[at:at + block], y[at:at + block])
                loss, g = loss + got, g + more
            n += len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([loss]), pa.array([n], pa.int64()),
                                              pa.array([g.tobytes()], pa.binary())], ["part", "loss", "rows", "gradient"])

    return rows.select("x", "y").mapInArrow(task, PARTIAL).withColumn("part", F.spark_partition_id())


def run_epoch(rows: DataFrame, n: int, state: State, sizes: list[int], epoch: int, seed: int, batch_rows: int,
              rate: float = RATE, alpha: float = ALPHA, slice_rows: int = SLICE_ROWS,
              parallel_rows: int = PARALLEL_ROWS, packed: DataFrame | None = None) -> tuple[State, float]:
    """The updates of one epoch over ``training_rows``: (state, mean loss).
    ``packed``: the epoch's rows if ``Epochs`` has them ready."""
    streamed = batch_rows < parallel_rows
    slices = _slices(n, batch_rows, slice_rows, parallel_rows)
    dealt = _dealt(rows, epoch, seed, slices) if packed is None else packed
    loss, left_x, left_y = 0.0, np.zeros((0, sizes[0])), np.zeros(0)
    for k in range(slices):
        part = dealt.filter(F.col("slice") == k) if slices > 1 else dealt
        if streamed:
            order = ["place", "key", "y", "x"] if packed is None else ["range", "at"]
            got = (part.select(*dict.fromkeys([*order, "x", "y"])).coalesce(1).sortWithinPartitions(*order).select("x", "y")
                   .mapInArrow(_stream(state, sizes, batch_rows, rate, alpha, left_x, left_y, k == slices - 1,
                                       packed is not None), STREAMED).toArrow())
            if got.num_rows:
                state = State.unpack(got["state"][0].as_py())
                left_x = np.asarray(got["x"][0].values, np.float64).reshape(-1, sizes[0])
                left_y = np.asarray(got["y"][0].values, np.float64)
                loss += got["loss"][0].as_py()
        else:
            sums = materialize(_partials(part, state, sizes), "net-sums")
            if not sums.isEmpty():
                got, m, gradient = tree_sum(sums)
                loss += got + state.penalty(sizes, alpha)
                state = state.own()
                state.step(sizes, gradient, m, rate, alpha)
            remove_stage(sums)
    if slices > 1 and packed is None:
        remove_stage(dealt)
    return state, loss / max(n, 1)


def accuracy(rows: DataFrame, state: State, sizes: list[int]) -> float:
    """Share of right labels of ``training_rows``, counted where they lie."""
    weights, width = state.weights, sizes[0]

    def task(batches):
        right = n = 0
        for b in batches:
            x, y = _matrix(pa.table(b), width)
            right += int(((outputs(weights, sizes, x)[-1][:, 0] > 0.5) == (y > 0.5)).sum()) if len(y) else 0
            n += len(y)
        yield pa.RecordBatch.from_arrays([pa.array([right], pa.int64()), pa.array([n], pa.int64())], ["right", "n"])

    got = rows.select("x", "y").mapInArrow(task, "right long, n long").agg(F.sum("right"), F.sum("n")).first()
    return (got[0] or 0) / got[1] if got[1] else 0.0


def hold_out(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """Rows with ``held``: the stratified share that decides when to stop."""
    if share <= 0:
        return rows.withColumn("held", F.lit(False))
    order = F.md5(F.concat_ws("-", F.col("key").cast("string"), F.lit(str(seed))))
    ranked = exact_row_number(rows, [order, F.col("key"), F.col("x")], ["y"], out="_rn", bucket=md5_bucket(order))
    quota = class_allocation(rows.groupBy("y").agg(F.count(F.lit(1)).alias("_nc")), share, "y")
    return ranked.join(quota.select("y", "_ntest"), "y").withColumn("held", F.col("_rn") <= F.col("_ntest")) \
        .select("key", "x", "y", "held")


def train(df: DataFrame, n_features: int, hidden: tuple[int, ...], epochs: int = 500, batch_rows: int = 200,
          early_stopping: bool = True, held_out: float = HELD_OUT, tol: float = TOL, patience: int = PATIENCE,
          rate: float = RATE, alpha: float = ALPHA, seed: int = 42, label: str = "label",
          features_col: str = "features", key_cols: list[str] | None = None, slice_rows: int = SLICE_ROWS,
          parallel_rows: int = PARALLEL_ROWS) -> NetworkModel:
    """Train from a fresh start; ``history`` holds loss and held-out accuracy
    of every epoch. Without early stopping it stops when the loss has not
    fallen by ``tol`` for more than ``patience`` epochs."""
    sizes = [n_features, *hidden, 1]
    rows = training_rows(df, label, features_col, key_cols)
    parts = materialize(hold_out(rows, held_out if early_stopping else 0.0, seed), "net-split")
    fit, held = parts.filter("NOT held"), parts.filter("held")
    n = fit.count()
    if not n:
        raise ValueError("no rows to train on")
    batch_rows = min(batch_rows, n)
    state, history = State.fresh(first_weights(sizes, seed)), []
    best, best_weights, waited = -math.inf, state.weights, 0
    with Epochs(fit, n, epochs, seed, n_features, batch_rows, slice_rows, parallel_rows) as order:
        for epoch in range(epochs):
            state, loss = run_epoch(fit, n, state, sizes, epoch, seed, batch_rows, rate, alpha, slice_rows, parallel_rows,
                                    order.take(epoch))
            score = accuracy(held, state, sizes) if early_stopping else -loss
            history.append({"epoch": epoch, "loss": loss, "score": score if early_stopping else None})
            waited = waited + 1 if score < best + tol else 0
            if score > best:
                best, best_weights = score, state.weights
            if waited > patience:
                break
    if early_stopping:
        state = replace(state, weights=best_weights)
    remove_stage(rows)
    remove_stage(parts)
    return NetworkModel(sizes, state, history, features_col)


def fine_tune(model: NetworkModel, df: DataFrame, epochs: int = 50, batch_rows: int = 64, rate: float = RATE,
              alpha: float = ALPHA, seed: int = 42, label: str = "label", key_cols: list[str] | None = None,
              slice_rows: int = SLICE_ROWS, parallel_rows: int = PARALLEL_ROWS) -> NetworkModel:
    """M7: ``epochs`` x ceil(n / batch_rows) further updates on new rows, from
    the model's weights and optimiser state; the model itself is unchanged."""
    rows = training_rows(df, label, model.features_col, key_cols)
    n = rows.count()
    state, history = replace(model.state), []
    epochs, batch_rows = epochs if n else 0, min(batch_rows, max(n, 1))
    with Epochs(rows, n, epochs, seed, model.sizes[0], batch_rows, slice_rows, parallel_rows) as order:
        for epoch in range(epochs):
            state, loss = run_epoch(rows, n, state, model.sizes, epoch, seed, batch_rows, rate, alpha, slice_rows,
                                    parallel_rows, order.take(epoch))
            history.append({"epoch": epoch, "loss": loss, "score": None})
    remove_stage(rows)
    return NetworkModel(model.sizes, state, history, model.features_col)
