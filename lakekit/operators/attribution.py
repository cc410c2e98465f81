"""Which feature moved a prediction: exact Shapley values over the trees of a fitted forest.

Every leaf of a tree is a path of conditions, at most one per feature (intervals of one feature are intersected). For a row a path has
one bit per feature: does the row meet its condition? A feature that is left open is met by the share of training rows that
went this way. The Shapley value of a path is the leaf's value times a sum over subsets of its features, which only depends on
how many are in the subset: the coefficients of a product of (share + bit * t). It is computed once per task for every bit pattern of a path
(once per batch for the patterns that occur, where the tables of all paths would be larger than ``TABLE_BYTES``).

The paths travel with the task; a forest whose paths are larger than ``most_bytes`` is refused. Rows are scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

MOST_BYTES = 64 << 20
TABLE_BYTES = 64 << 20


class Path(NamedTuple):
    """A leaf: its features, the condition on each (bounds: low < x <= high, or a set of categories), shares, value."""

    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    categories: tuple[frozenset | None, ...]
    share: tuple[float, ...]
    value: float


def paths_of(model) -> list[Path]:
    """The paths of a forest's trees; values are the leaf's share of the positive class, or its mean, over the number of trees."""
    trees = model.trees if hasattr(model, "trees") else [model]
    out: list[Path] = []
    for tree in trees:
        stack = [(tree._java_obj.rootNode() if hasattr(tree._java_obj, "rootNode") else tree._call_java("rootNode"), {})]
        while stack:
            node, met = stack.pop()
            stats = node.impurityStats()
            if not hasattr(node, "leftChild") or node.subtreeDepth() == 0:
                counts = list(stats.stats())
                value = counts[1] / sum(counts) if len(counts) == 2 and hasattr(model, "numClasses") else node.prediction()
                f = sorted(met)
                out.append(Path(tuple(f), *(tuple(met[i][j] for i in f) for j in range(4)), value / len(trees)))
                continue
            split, at = node.split(), node.split().featureIndex()
            low, high, cats, share = met.get(at, (-np.inf, np.inf, None, 1.0))
            total = float(stats.count())
            for side, child in (("left", node.leftChild()), ("right", node.rightChild())):
                part = share * float(child.impurityStats().count()) / total
                if hasattr(split, "threshold") and "Continuous" in split.getClass().getName():
                    t = float(split.threshold())
                    new = (low, min(high, t), cats, part) if side == "left" else (max(low, t), high, cats, part)
                else:
                    mine = frozenset(split.leftCategories() if side == "left" else split.rightCategories())
                    new = (low, high, mine if cats is None else cats & mine, part)
                stack.append((child, met | {at: new}))
    return out


def path_values(path: Path, bits: np.ndarray) -> np.ndarray:
    """Shapley value of every feature of a path for every row of bits."""
    m = len(path.features)
    share = np.array(path.share)
    weight = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    out = np.empty((len(bits), m))
    for i in range(m):
        poly = np.zeros((len(bits), m))
        poly[:, 0] = 1.0
        for j in range(m):
            if j != i:
                shifted = np.zeros_like(poly)
                shifted[:, 1:] = poly[:, :-1] * bits[:, j : j + 1]
                poly = poly * share[j] + shifted
        out[:, i] = path.value * (bits[:, i] - share[i]) * (poly @ weight)
    return out


def base_value(paths: Sequence[Path]) -> float:
    """The prediction when no feature is known."""
    return float(sum(p.value * np.prod(p.share) for p in paths))


def tables(paths: Sequence[Path], most_bytes: int = TABLE_BYTES) -> list[np.ndarray | None]:
    """For every path its Shapley values under all patterns of bits (a row per feature, a column per pattern), as far as ``most_bytes`` go."""
    out, left = [], most_bytes
    for p in paths:
        m = len(p.features)
        size = 8 * m << m
        if not 0 < m <= 10 or size > left:
            out.append(None)
            continue
        left -= size
        out.append(np.ascontiguousarray(path_values(p, (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)).T))
    return out


def shapley(paths: Sequence[Path], x: np.ndarray, known: Sequence[np.ndarray | None] | None = None) -> np.ndarray:
    """Shapley values of all features (columns of x) for all rows; ``known``: the ``tables`` of the paths, if a caller has many batches.

    The bits of a row under a path are one number, which looks up its values; without a table, those of the numbers that occur are computed.
    """
    known = [None] * len(paths) if known is None else known
    cols, out = np.ascontiguousarray(x.T), np.zeros(x.shape[::-1])
    for p, table in zip(paths, known):
        if not p.features:
            continue
        bits = [_meets(cols[f], low, high, c) for f, low, high, c in zip(p.features, p.low, p.high, p.categories)]
        if table is None:
            patterns, which = np.unique(np.packbits(np.stack(bits, 1), axis=1), axis=0, return_inverse=True)
            table, code = path_values(p, np.unpackbits(patterns, axis=1)[:, : len(bits)].astype(float)).T, which.ravel()
        else:
            code = np.zeros(len(x), np.uint16)
            for j, b in enumerate(bits):
                code |= b.astype(np.uint16) << np.uint16(j)
        for f, values in zip(p.features, table):
            out[f] += values[code]
    return out.T


def _meets(col: np.ndarray, low: float, high: float, categories: frozenset | None) -> np.ndarray:
    if categories is not None:
        return np.isin(col, list(categories))
    return (col > low) & (col <= high)


def attributions(model, df: DataFrame, features: str = "features", keep: Sequence[str] = (), most_bytes: int = MOST_BYTES) -> DataFrame:
    """The ``keep`` columns with ``base`` and ``attribution``, one value per feature; base and values add up to the prediction
    (the probability of class 1 for a classifier's forest). No row is left out; an empty frame gives none."""
    paths = paths_of(model)
    size = sum(48 * len(p.features) + 8 * sum(len(c) for c in p.categories if c) + 64 for p in paths)
    if size > most_bytes:
        raise ValueError(f"the forest's paths take {size} bytes, more than {most_bytes}: use fewer or lower trees")
    base = base_value(paths)
    rows = df.select(*keep, vector_to_array(features).alias("_x"))
    out = T.StructType([rows.schema[c] for c in keep] + T.StructType.fromDDL("base double, attribution array<double>").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables(paths)
        for b in batches:
            if b.num_rows:
                x = b.column("_x").flatten().to_numpy().reshape(b.num_rows, -1)
                v = shapley(paths, x, known)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32)), pa.array(v.ravel()))
                yield pa.record_batch([*[b.column(c) for c in keep], pa.array(np.full(b.num_rows, base)), lists], names=[*keep, "base", "attribution"])

    return rows.mapInArrow(run, out)


def by_feature(values: DataFrame, names: Sequence[str]) -> DataFrame:
    """feature, n, mean_attribution, mean_absolute: one row per feature, the most telling first."""
    each = values.select(F.posexplode("attribution").alias("i", "v")).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean_attribution"), F.avg(F.abs("v")).alias("mean_absolute"))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    return each.select(named.alias("feature"), "n", "mean_attribution", "mean_absolute").orderBy(F.desc("mean_absolute"), "feature")
