"""Spark's multilayer perceptron, trained on blocks of rows by matrix products in the tasks.

The network, its first weights, the loss (cross entropy of a softmax over sigmoid layers) and the optimiser (L-BFGS with ten corrections and a
search for the strong Wolfe conditions) are those of ``MultilayerPerceptronClassifier``, and its model is returned. The rows are packed once
into blocks of single precision; each evaluation reads the blocks and adds up loss and gradient in double precision, per task, then per group of tasks,
so that only ``GROUPS`` rows of the size of the network reach the driver.
"""

from __future__ import annotations

from collections import deque
from math import isfinite, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

BLOCK = 2048
GROUPS = 16


class SearchFailed(Exception):
    pass


def layers_of(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, shift) of every layer as views, in the order in which Spark keeps them."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def loss_and_gradient(flat: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sums over the rows, in the precision of ``x`` but for the sums."""
    w = [(m.astype(x.dtype), s.astype(x.dtype)) for m, s in layers_of(flat, sizes)]
    kept = [x]
    for m, s in w[:-1]:
        kept.append(0.5 * np.tanh(0.5 * (kept[-1] @ m + s)) + x.dtype.type(0.5))
    z = kept[-1] @ w[-1][0] + w[-1][1]
    z -= z.max(1, keepdims=True)
    e = np.exp(z)
    total = e.sum(1)
    every = np.arange(len(y))
    loss = float(np.sum(np.log(total) - z[every, y], dtype=np.float64))
    d = e / total[:, None]
    d[every, y] -= 1
    grad = np.zeros(len(flat))
    for i, (gm, gs) in reversed([*enumerate(layers_of(grad, sizes))]):
        gm[...], gs[...] = kept[i].T @ d, d.sum(0)
        if i:
            d = (d @ w[i][0].T) * kept[i] * (1 - kept[i])
    return loss, grad


def _blocks(batches, inputs: int):
    for b in batches:
        x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, inputs).astype(np.float32)
        y = b.column("y").to_numpy().astype(np.uint8)
        for i in range(0, len(y), BLOCK):
            yield pa.record_batch([pa.array([x[i : i + BLOCK].tobytes()]), pa.array([y[i : i + BLOCK].tobytes()])], names=["x", "y"])


def _summed(batches, sizes: list[int], flat: np.ndarray):
    state = np.zeros(2 + len(flat))
    for b in batches:
        for xb, yb in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
            y = np.frombuffer(yb, np.uint8)
            loss, grad = loss_and_gradient(flat, sizes, np.frombuffer(xb, np.float32).reshape(len(y), sizes[0]), y)
            state[0] += len(y)
            state[1] += loss
            state[2:] += grad
    yield pa.record_batch([pa.array([TaskContext.get().partitionId() % GROUPS], pa.int32()), pa.array([state.tobytes()])], names=["g", "state"])


def _added(table: pa.Table) -> pa.Table:
    return pa.table({"state": [sum(np.frombuffer(s) for s in table.column("state").to_pylist()).tobytes()]})


def minimise(fun, x: np.ndarray, steps: int, tolerance: float, memory: int = 10) -> np.ndarray:
    """L-BFGS; ``fun`` gives value and gradient."""
    value, grad = fun(x)
    first, values, past = value, deque([value], 10), deque(maxlen=memory)
    failed = False
    for step in range(steps):
        if np.linalg.norm(grad) <= max(tolerance * abs(value), 1e-8):
            break
        direction = -_product(past, grad)
        try:
            t, new_value, new_grad = _search(fun, x, value, grad, direction, 1.0 if step else 1 / np.linalg.norm(direction))
        except SearchFailed:
            if failed or not past:
                break
            failed, past = True, deque(maxlen=memory)
            continue
        failed = False
        past.append((t * direction, new_grad - grad))
        x, value, grad = x + t * direction, new_value, new_grad
        if abs(value - max(values)) <= tolerance * abs(first):
            break
        values.append(value)
    return x


def _product(past, grad: np.ndarray) -> np.ndarray:
    q, keep = grad.copy(), []
    for s, y in reversed(past):
        a = (s @ q) / (s @ y)
        q -= a * y
        keep.append(a)
    if past:
        s, y = past[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(past, reversed(keep)):
        q += (a - (y @ q) / (s @ y)) * s
    return q


def _search(fun, x, value, grad, direction, t, c1: float = 1e-4, c2: float = 0.9):
    """(step, value, gradient) with enough decrease and a slope flat enough."""
    slope = float(grad @ direction)
    if slope > 0:
        raise SearchFailed

    def at(t):
        v, g = fun(x + t * direction)
        return t, v, float(g @ direction), g

    def between(a, b):
        if a[0] > b[0]:
            a, b = b, a
        d1 = a[2] + b[2] - 3 * (a[1] - b[1]) / (a[0] - b[0])
        root = d1 * d1 - a[2] * b[2]
        d2 = sqrt(root) if root >= 0 else float("nan")
        t = b[0] - (b[0] - a[0]) * (b[2] + d2 - d1) / (b[2] - a[2] + 2 * d2)
        low, high = a[0] + 0.1 * (b[0] - a[0]), a[0] + 0.9 * (b[0] - a[0])
        return min(high, max(low, t)) if isfinite(t) else (low + high) / 2

    def zoom(low, high):
        for _ in range(10):
            c = at(between(low, high))
            if c[1] > value + c1 * c[0] * slope or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= c2 * abs(slope):
                    return c
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise SearchFailed

    low = (0.0, value, slope, grad)
    for i in range(10):
        c = at(t)
        if not isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + c1 * t * slope or (i and c[1] >= low[1]):
            c = zoom(low, c)
        elif abs(c[2]) > c2 * abs(slope):
            if c[2] < 0:
                low, t = c, 1.5 * t
                continue
            c = zoom(c, low)
        return c[0], c[1], c[3]
    raise SearchFailed


def fit(est: MultilayerPerceptronClassifier, df: DataFrame) -> MultilayerPerceptronClassificationModel:
    """The model of ``est``; labels are whole numbers from 0."""
    sizes, spark = list(est.getLayers()), df.sparkSession
    few = df.limit(2).select(est.getFeaturesCol(), est.getLabelCol()).persist()
    made = lambda params: est.copy(params | {est.maxIter: 0}).fit(few)
    start = est.getInitialWeights() if est.isDefined(est.initialWeights) else made({}).weights
    label = F.col(est.getLabelCol())
    checked = F.when((label >= 0) & (label < sizes[-1]) & (label == F.floor(label)), label).otherwise(F.raise_error(F.lit("labels must be whole numbers below the number of outputs")))
    rows = df.select(vector_to_array(est.getFeaturesCol(), "float32").alias("x"), checked.cast("int").alias("y"))
    blocks = rows.mapInArrow(lambda bs: _blocks(bs, sizes[0]), "x binary, y binary").persist()

    def fun(flat: np.ndarray) -> tuple[float, np.ndarray]:
        sent = spark.sparkContext.broadcast(flat)
        parts = blocks.mapInArrow(lambda bs: _summed(bs, sizes, sent.value), "g int, state binary")
        total = sum(np.frombuffer(r.state) for r in parts.groupBy("g").applyInArrow(_added, "state binary").collect())
        sent.unpersist()
        return total[1] / total[0], total[2:] / total[0]

    found = minimise(fun, np.array(start.toArray()), est.getMaxIter(), est.getTol())
    blocks.unpersist()
    model = made({est.initialWeights: Vectors.dense(found)})
    few.unpersist()
    return model
