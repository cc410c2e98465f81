"""A small neural classifier trained by mini-batches in the tasks that hold the rows.

Every task goes through its rows in mini-batches from the shared state of the network; at the end of a round the states of all tasks,
weighted by their rows, are averaged: first in ``groups`` groups on the executors, then the group sums (``groups`` rows of a size
that only the network sets) on the driver. A round is a slice of the rows by hash, so an epoch has as many rounds as wanted and reads
each row once for training. No row leaves its task.

Hidden layers are linear, ReLU, batch normalisation; dropout stands before the single output; loss is the cross entropy of the output
through a sigmoid; the steps are Adam's. The mean, variance and moments that a task has gathered are averaged like weights.

Rows whose label or features are NULL take no part in training and have a NULL probability. Without such rows the network stays as
drawn, of no inputs at all: it scores rows without features only. With one partitioning, results do not depend on retries: draws
depend on seed, epoch, round and partition alone. Columns other than label and features are not read by ``fit`` and pass through
``transform``. Tasks should hold a mix of both labels (``ml.keep_for_training`` deals rows out evenly).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

EPSILON = 1e-5
PART_DDL = "part int, n long, loss double, state binary"


@dataclass(frozen=True)
class Shape:
    inputs: int
    hidden: tuple[int, ...] = (64, 64)
    dropout: float = 0.1
    rate: float = 0.001
    momentum: float = 0.1  # share of a new batch in the running mean and variance

    def weights(self) -> list[tuple[int, ...]]:
        """Shapes of the trained arrays: matrix, shift, scale, offset of every hidden layer, then matrix and shift of the output."""
        sizes, out = (self.inputs, *self.hidden), []
        for a, b in zip(sizes, sizes[1:]):
            out += [(a, b), (b,), (b,), (b,)]
        return [*out, (sizes[-1], 1), (1,)]

    def n_weights(self) -> int:
        return sum(int(np.prod(s)) for s in self.weights())


def cut(flat: np.ndarray, shapes: Sequence[tuple[int, ...]]) -> list[np.ndarray]:
    """Views of one flat array."""
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return [part.reshape(s) for part, s in zip(np.split(flat[: ends[-1]], ends[:-1]), shapes)]


class Net:
    """The whole state lies in one array: weights, both moments of Adam, running means and variances, number of steps."""

    def __init__(self, shape: Shape, state: np.ndarray | None = None, seed: int = 42):
        self.shape, n = shape, shape.n_weights()
        units = sum(shape.hidden)
        self.state = np.zeros(3 * n + 2 * units + 1) if state is None else state.copy()
        self.flat, self.first, self.second = self.state[:n], self.state[n : 2 * n], self.state[2 * n : 3 * n]
        self.w = cut(self.flat, shape.weights())
        layers = [(h,) for h in shape.hidden]
        self.mean, self.var = cut(self.state[3 * n : 3 * n + units], layers), cut(self.state[3 * n + units : -1], layers)
        if state is None:
            rng = np.random.default_rng(seed)
            for i, s in enumerate(shape.weights()):
                fan = max(shape.weights()[i - i % 4][0], 1) ** -0.5
                self.w[i][...] = 1.0 if i % 4 == 2 and i < 4 * len(layers) else 0.0 if i % 4 == 3 else rng.uniform(-fan, fan, s)
            for v in self.var:
                v[...] = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        for i in range(len(self.shape.hidden)):
            m, b, scale, offset = self.w[4 * i : 4 * i + 4]
            x = (np.maximum(x @ m + b, 0) - self.mean[i]) / np.sqrt(self.var[i] + EPSILON) * scale + offset
        return _sigmoid((x @ self.w[-2] + self.w[-1])[:, 0])

    def gradient(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray | float = 1.0) -> tuple[float, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(mean loss of a mini-batch, gradient of the weights, mean and variance per hidden layer)."""
        n, seen, kept = len(y), [], []
        for i in range(len(self.shape.hidden)):
            m, b, scale, offset = self.w[4 * i : 4 * i + 4]
            z = x @ m + b
            a = np.maximum(z, 0)
            mean, var = a.mean(0), a.var(0)
            inv = 1 / np.sqrt(var + EPSILON)
            unit = (a - mean) * inv
            seen.append((mean, var))
            kept.append((x, z, unit, inv))
            x = unit * scale + offset
        x = x * mask
        o = (x @ self.w[-2] + self.w[-1])[:, 0]
        loss = float(np.mean(np.logaddexp(0, o) - y * o))
        grad = np.zeros_like(self.flat)
        g = cut(grad, self.shape.weights())
        d = ((_sigmoid(o) - y) / n)[:, None]
        g[-2][...], g[-1][...] = x.T @ d, d.sum(0)
        d = d @ self.w[-2].T * mask
        for i in range(len(self.shape.hidden) - 1, -1, -1):
            m, _, scale, _ = self.w[4 * i : 4 * i + 4]
            before, z, unit, inv = kept[i]
            g[4 * i + 2][...], g[4 * i + 3][...] = (d * unit).sum(0), d.sum(0)
            d = d * scale
            d = inv * (d - d.mean(0) - unit * (d * unit).mean(0)) * (z > 0)
            g[4 * i][...], g[4 * i + 1][...] = before.T @ d, d.sum(0)
            d = d @ m.T
        return loss, grad, seen

    def step(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> float:
        keep = 1 - self.shape.dropout
        mask = (rng.random((len(y), self.shape.hidden[-1])) < keep) / keep
        loss, grad, seen = self.gradient(x, y, mask)
        for i, (mean, var) in enumerate(seen):
            self.mean[i] += self.shape.momentum * (mean - self.mean[i])
            self.var[i] += self.shape.momentum * (var * len(y) / max(len(y) - 1, 1) - self.var[i])
        self.state[-1] += 1
        t = self.state[-1]
        self.first += 0.1 * (grad - self.first)
        self.second += 0.001 * (grad**2 - self.second)
        self.flat -= self.shape.rate * (self.first / (1 - 0.9**t)) / (np.sqrt(self.second / (1 - 0.999**t)) + 1e-8)
        return loss


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def mini_batches(blocks: Iterator[tuple[np.ndarray, np.ndarray]], size: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shuffled mini-batches of ``size`` rows; the last ones share what is left evenly, so none is a lone row unless the task has no other."""
    x, y = None, None
    for bx, by in blocks:
        x, y = (bx, by) if x is None else (np.concatenate([x, bx]), np.concatenate([y, by]))
        if len(y) < 2 * size:
            continue
        order = rng.permutation(len(y))
        x, y = x[order], y[order]
        full = len(y) // size - 1
        for i in range(full):
            yield x[i * size : (i + 1) * size], y[i * size : (i + 1) * size]
        x, y = x[full * size :], y[full * size :]
    if y is not None and len(y):
        order = rng.permutation(len(y))
        yield from ((x[i], y[i]) for i in np.array_split(order, -(-len(y) // size)))


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _train(batches: Iterator[pa.RecordBatch], shape: Shape, state: np.ndarray, size: int, draw: list[int]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    rng, net, n, loss = np.random.default_rng([*draw, part]), Net(shape, state), 0, 0.0
    blocks = ((_matrix(b.column("x"), shape.inputs), b.column("y").to_numpy()) for b in batches if b.num_rows)
    for x, y in mini_batches(blocks, size, rng):
        loss += net.step(x, y, rng) * len(y)
        n += len(y)
    if n:
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([loss]), pa.array([net.state.tobytes()], pa.binary())], names=["part", "n", "loss", "state"])


def _sum(rows: pd.DataFrame) -> pd.DataFrame:
    """Weighted sum of states; one result per group."""
    rows, total = rows.sort_values("part"), 0.0
    for n, s in zip(rows["n"], rows["state"]):
        total = total + n * np.frombuffer(s)
    return pd.DataFrame({"part": [int(rows["g"].iloc[0])], "n": [int(rows["n"].sum())], "loss": [float(rows["loss"].sum())], "state": [total.tobytes()]})


@dataclass
class NetClassifier:
    """``fit`` gives a model; ``rounds`` is how often the tasks' states are averaged in an epoch."""

    label: str = "label"
    features: str = "features"
    hidden: tuple[int, ...] = (64, 64)
    epochs: int = 2
    batch: int = 128
    rate: float = 0.001
    dropout: float = 0.1
    rounds: int = 4
    seed: int = 42
    groups: int = 32

    def fit(self, df: DataFrame) -> "NetModel":
        rows = df.select(_plain(df, self.features).alias("x"), F.col(self.label).cast("double").alias("y")).where("x is not null and y is not null")
        first = rows.select(F.size("x")).first()
        shape = Shape(first[0] if first else 0, tuple(self.hidden), self.dropout, self.rate)
        net, history = Net(shape, seed=self.seed), []
        for epoch in range(self.epochs if first else 0):
            # every epoch deals the rows into other rounds; equal rows share one
            slot = F.pmod(F.xxhash64("x", "y", F.lit(self.seed + epoch)), F.lit(self.rounds))
            for r in range(self.rounds):
                state, size, draw = net.state, self.batch, [self.seed, epoch, r]
                parts = rows.where(slot == r).mapInArrow(lambda bs, state=state, draw=draw: _train(bs, shape, state, size, draw), PART_DDL)
                sums = parts.withColumn("g", F.pmod("part", F.lit(self.groups))).groupBy("g").applyInPandas(_sum, PART_DDL)
                got = sorted(sums.collect(), key=lambda s: s.part)  # at most ``groups`` rows
                n = sum(s.n for s in got)
                if n:
                    net = Net(shape, sum(np.frombuffer(s.state) for s in got) / n)
                    history.append((epoch, r, n, sum(s.loss for s in got) / n))
        return NetModel(self, net, history)


class NetModel:
    def __init__(self, settings: NetClassifier, net: Net, history: list[tuple[int, int, int, float]]):
        self.settings, self.net, self._history = settings, net, history

    def history(self, spark) -> DataFrame:
        """Rows and mean loss of every round, as it was while training."""
        return spark.createDataFrame(self._history, "epoch int, round int, n long, loss double")

    def transform(self, df: DataFrame) -> DataFrame:
        """``probability`` (of the classes 0 and 1) and ``prediction``; columns of these names are replaced."""
        shape, state = self.net.shape, self.net.state

        @F.pandas_udf(T.DoubleType())
        def one(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            net = Net(shape, state)
            for s in parts:
                out = np.full(len(s), np.nan)
                there = s.notna().to_numpy()
                if there.any():
                    out[there] = net.probabilities(np.stack(s[there].to_list()).astype(np.float64))
                yield pd.Series(out).where(pd.Series(there), None)

        p = df.withColumn("_p", one(_plain(df, self.settings.features)))
        p = p.withColumns({"probability": F.when(F.col("_p").isNotNull(), array_to_vector(F.array(1 - F.col("_p"), "_p"))), "prediction": F.when(F.col("_p").isNotNull(), (F.col("_p") >= 0.5).cast("double"))})
        return p.drop("_p")


def _plain(df: DataFrame, features: str):
    """Vectors as arrays; arrays with a NULL inside count as NULL."""
    if isinstance(df.schema[features].dataType, T.ArrayType):
        return F.when(~F.exists(features, lambda v: v.isNull()), F.col(features).cast("array<double>"))
    return F.when(F.col(features).isNotNull(), vector_to_array(features))
