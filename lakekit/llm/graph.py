"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import runs, stored


def _forest(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Replace the links of a task by a star for each of their components, as many links at a time as stay small."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) > 2 * most:
            yield _stars(held)
            held = []
    if held:
        yield _stars(held)


def _stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    a, b = (np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1))
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")
    first = runs(both[order])
    names, at = both[order][first], np.empty(len(both), np.int64)
    at[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(both))))
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = np.flatnonzero(root != np.arange(len(names)))
    return pa.record_batch({"a": pa.array(names[own]), "b": pa.array(names[root[own]])})


def components(links: DataFrame, chunk: int = 1 << 18) -> DataFrame:
    """node, root (the smallest node that links reach from it) for every node of ``links`` (a, b: long).

    Alternating star contraction: every node hands its larger neighbours, then its smaller ones, to the smallest of them. Minima
    are combined on the map side and joined back, so a node with very many links is no group anywhere. Before each round, every
    task contracts ``chunk`` links to stars by itself; when all that is left is one chunk, this is the answer. The rounds grow
    with the logarithm of the longest chain. Each is written to the shared folder.
    """
    e = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        n = e.count()
        parts = max(1, -(-n // chunk))
        e = stored(e.repartition(parts).mapInArrow(lambda bs: _forest(bs, chunk), "a long, b long"), "links")
        if parts == 1:
            break
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, both["a"] == low["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "links")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(low, large["a"] == low["u"])
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        e = stored(small, "links")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
