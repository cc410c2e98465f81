"""Exact top-k inner products by columnar branch and bound.

Vectors are turned into whole numbers and packed into blocks of rows in vertical layout: one array per dimension. Every
(query block, row block) pair is one small unit of work, found by an equi join on the two block numbers, so queries meet all
rows in blocks of bounded size and nothing is broadcast. Inside a unit, scores are accumulated a few dimensions at a time;
after every step the product of the remaining norms bounds what a row can still gain or lose, rows that cannot reach the
k-th best any more are dropped and the arrays compacted. A last window over k rows per unit gives the answer.

Arithmetic is exact: whole numbers in 64 bits, or Python's where a product could leave them (such a score is then cut to the
64-bit range for the result, and ranked by its double). Bounds are widened by more than the error of double arithmetic.

Vectors that are NULL or hold NULL, NaN or infinity take no part; empty vectors do, with all scores 0. Vectors of several
lengths are compared as if padded by zeros. Equal scores go to the smaller id. Ids may repeat: every row counts, each as
its own query and as a candidate of the others. A NULL id is never a query and is the last among ties. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import stored

STEP = 8
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def whole(vectors: DataFrame, vec_id: str, embedding: str, scale: int, *more: str) -> DataFrame:
    """(id, v, more columns): usable vectors times ``scale``; the floor is taken where they are packed, as doubles, which hold it exactly."""
    v = F.transform(F.col(embedding), lambda x: F.lit(float(scale)) * x.cast("double"))
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col(embedding).isNotNull() & fine).select(F.col(vec_id).cast("long").alias("id"), v.alias("v"), *more)


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``rows`` rows, one column of the block after the other."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            part = b.slice(at, rows)
            col = part.column("v")
            size = np.diff(np.asarray(col.offsets))
            dim = int(size.max(initial=0))
            m = np.zeros((part.num_rows, dim))
            m[np.arange(dim) < size[:, None]] = np.floor(col.flatten().to_numpy(zero_copy_only=False))
            yield pa.record_batch({"n": pa.array([part.num_rows], pa.int32()), "dim": pa.array([dim], pa.int32()), "ids": pa.array([_bytes(part.column("id"))], pa.binary()),
                                   "known": pa.array([part.column("id").is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()),
                                   "uids": pa.array([part.column("uid").to_numpy().astype(np.int64).tobytes()], pa.binary()), "cols": pa.array([m.T.tobytes()], pa.binary())})


def _bytes(ids: pa.Array) -> bytes:
    return ids.fill_null(HIGH).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()


_PACKED = "n int, dim int, ids binary, known binary, uids binary, cols binary"


def _numbered(blocks: DataFrame, name: str, label: str) -> DataFrame:
    """Blocks written once with a dense number from 0; the window holds one small row per block, not the block."""
    b = stored(blocks.withColumn("_key", F.monotonically_increasing_id()), label)
    at = b.select("_key").withColumn(name, F.row_number().over(W.orderBy("_key")) - 1)
    return stored(b.join(at, "_key").drop("_key"), label)


def _columns(row: dict, dim: int, kind) -> list[np.ndarray]:
    m = np.frombuffer(row["cols"]).reshape(row["dim"], row["n"])
    return [m[d].astype(kind) if d < row["dim"] else np.zeros(row["n"], kind) for d in range(dim)]


def best_of(q: np.ndarray, uid: int, cols: list[np.ndarray], left: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k best rows of a block for one query; left[j]: norms of the dimensions from j steps on."""
    at = np.flatnonzero(uids != uid)
    score = np.zeros(len(at), np.int64 if exact else object)
    live = [c[at] for c in cols] if len(at) < len(ids) else cols
    for j, first in enumerate(range(0, len(cols), STEP)):
        for d in range(first, min(first + STEP, len(cols))):
            if q[d]:
                score = score + q[d] * live[d]
        rest = left[j + 1][at] * _norm(q[first + STEP :])
        if len(at) > k and first + STEP < len(cols):
            now = score.astype(float)
            slack = rest * 1.000001 + np.abs(now) * 1e-12 + 1
            floor_ = np.partition(now - slack, len(at) - k)[len(at) - k]
            keep = now + slack >= floor_
            if keep.sum() < 0.7 * len(at):
                at, score, live = at[keep], score[keep], [c[keep] if d >= first + STEP else c[:0] for d, c in enumerate(live)]
    if len(at) > k:
        edge = np.partition(score, len(at) - k)[len(at) - k] if exact else sorted(score)[len(at) - k]
        sure, tied = np.flatnonzero(score > edge), np.flatnonzero(score == edge)
        pick = np.concatenate((sure, tied[np.argsort(ids[at[tied]], kind="stable")][: k - len(sure)]))
        at, score = at[pick], score[pick]
    return at, score


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt(np.sum(np.square(x.astype(float)))))


def _units(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            q, r = row["q"], row["r"]
            dim = max(q["dim"], r["dim"])
            top = [np.abs(np.frombuffer(x["cols"])).max(initial=0) for x in (q, r)]
            exact = top[0] * top[1] * max(dim, 1) < 2.0**62 and max(top) < 2.0**62
            if exact:
                qc, rc = _columns(q, dim, np.int64), _columns(r, dim, np.int64)
            else:
                qc, rc = ([np.array([int(v) for v in c], object) for c in _columns(x, dim, float)] for x in (q, r))
            ids, uids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["uids"], np.int64)
            square = np.array([np.square(c.astype(float)) for c in rc]).reshape(dim, len(ids))
            left = [np.sqrt(square[first:].sum(0)) for first in range(0, dim + STEP, STEP)]
            qids, quids = np.frombuffer(q["ids"], np.int64), np.frombuffer(q["uids"], np.int64)
            known = np.frombuffer(r["known"], np.uint8).astype(bool)
            out: list[tuple] = []
            for i in range(q["n"]):
                at, score = best_of(np.array([c[i] for c in qc], np.int64 if exact else object), int(quids[i]), rc, left, ids, uids, k, exact)
                out += [(int(quids[i]), int(qids[i]), int(ids[a]) if known[a] else None, int(s)) for a, s in zip(at, score)]
            cut = [min(max(x[3], LOW), HIGH) for x in out]
            yield pa.record_batch({"uid": pa.array([x[0] for x in out], pa.int64()), "query_id": pa.array([x[1] for x in out], pa.int64()), "vec_id": pa.array([x[2] for x in out], pa.int64()),
                                   "score": pa.array(cut, pa.int64()), "over": pa.array([None if c == x[3] else float(x[3]) for c, x in zip(cut, out)], pa.float64())})


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10, scale: int = 1024, query_rows: int = 256, block_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner product for every row where ``is_query`` (over the id) holds."""
    v = whole(vectors, vec_id, embedding, scale)
    spread = v.select("*", F.monotonically_increasing_id().alias("uid"))
    rows = stored(spread, "vectors")
    n = rows.count()
    parts = max(1, -(-n // block_rows))
    blocks = lambda df, size, count: df.repartition(count).mapInArrow(lambda bs: _pack(bs, size), _PACKED)
    named = rows.select("id", "uid", "v")
    queries = named.where(F.col("id").isNotNull() & is_query)
    r = _numbered(blocks(named, block_rows, parts), "rb", "rows")
    q = _numbered(blocks(queries, query_rows, max(1, -(-queries.count() // query_rows))), "qb", "queries")
    nr, nq = r.count(), q.count()
    if not nr or not nq:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cells = lambda own, other, count: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(other)
    packed = F.struct(*[c.split()[0] for c in _PACKED.split(", ")])
    left = q.select("qb", packed.alias("q"), cells("qb", "rb", nr))
    right = r.select("rb", packed.alias("r"), cells("rb", "qb", nq))
    units = left.join(right.hint("merge"), ["qb", "rb"]).select("q", "r")
    found = units.mapInArrow(lambda bs: _units(bs, k), "uid long, query_id long, vec_id long, score long, over double")
    w = W.partitionBy("uid").orderBy(F.desc("score"), F.desc_nulls_last("over"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
