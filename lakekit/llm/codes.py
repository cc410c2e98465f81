"""Vector code compression: every part of a vector becomes the number of its nearest codebook entry, under adaptive bounds.

Vectors are turned into whole numbers (floor of ``scale`` times each component) and cut into ``parts`` equal consecutive parts. The
codebook of a part position starts as that part of the ``entries`` smallest ids (fewer, if there are fewer vectors). Every round
assigns each part to the nearest entry (squared distance, ties to the lower number) and moves every entry to the componentwise floor
of its parts' mean; an entry without parts stays. A last assignment gives the codes.

*Drake-Hamerly bounds.* With every part its ``b`` closest entries are kept in a written table, by ascending lower bounds of
their distances, an upper bound for its own entry and one outer bound for all entries not listed. When entries move, bounds are loosened by how far
each has moved (the outer one by the farthest move). A part whose upper bound lies below its first lower bound keeps its entry
unseen. Otherwise the distance to its own entry is taken anew, then to those listed entries whose bound lies under it, and only if the
outer bound lies under it, to all. ``b`` adapts: every round counts how deep the lists were read, and the next one keeps the least
power of two that served all but ``MISSES`` of the parts.

Bounds are doubles, widened by more than their rounding; whatever they do not decide is compared in whole numbers, so codes and ties
are exact. Squared distances up to 2^52 are taken by matrix products of doubles, which hold them exactly, larger ones by Python's integers.

Sums of a codebook entry are combined in the task, then over the tasks; to the driver go the codebooks (parts * entries vectors) and
the counts of depths. The tables of earlier rounds are deleted once the next one is written.

Vectors that are NULL or hold NULL, NaN or infinity take no part. Vectors of several lengths are padded by zeros to the longest one,
and all to a multiple of ``parts``. Repeated ids and vectors are rows of their own; equal ids are ordered by their vectors where the codebook starts,
NULL ids come last there. Labels may be NULL, which is a label. Errors beyond 64 bits are cut to that range. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, stored
from .topk import whole

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MOST_LISTED = 16
MISSES = 0.01
TOP = (1 << 63) - 1
EXACT = 2.0**52
WIDE, NARROW = 1 + 1e-9, 1 - 1e-9


class Books(NamedTuple):
    """Codebooks: entries[part] is a matrix of whole numbers (entry, component), int64 or, beyond 52 bits of squared distance, Python's."""

    entries: list[np.ndarray]

    def text(self) -> str:
        return ",".join(str(int(v)) for m in self.entries for v in m.ravel())

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def fits(top: int, width: int) -> bool:
    """Are squared distances of components up to ``top`` below 2^52?"""
    return 4.0 * float(top) ** 2 * max(width, 1) < EXACT


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all entries, exact."""
    if x.dtype == object:
        return np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in book] for r in x], object).reshape(len(x), len(book))
    xf, bf = x.astype(float), book.astype(float)
    return np.square(xf).sum(1)[:, None] + np.square(bf).sum(1)[None] - 2.0 * (xf @ bf.T)


def listed(x: np.ndarray, book: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to the entries named in its row of ``at``."""
    d = x[:, None, :] - book[at]
    return (d * d).sum(2) if x.dtype == object else np.einsum("ijk,ijk->ij", d, d).astype(float)


def roots(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(float))


class Lists(NamedTuple):
    """The state of all parts at one position: own entry, upper bound, listed entries with ascending lower bounds, outer bound."""

    own: np.ndarray
    upper: np.ndarray
    at: np.ndarray
    lower: np.ndarray
    outer: np.ndarray


def full(x: np.ndarray, book: np.ndarray, b: int) -> tuple[Lists, np.ndarray]:
    """Lists from all distances, and the distance to the own entry."""
    own, best = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype if x.dtype == object else float)
    at, lower, outer = np.zeros((len(x), b), np.int64), np.full((len(x), b), np.inf), np.full(len(x), np.inf)
    for i in range(0, len(x), 4096):
        s = slice(i, i + 4096)
        d = distances(x[s], book)
        row = np.arange(len(d))
        own[s] = np.argmin(d, axis=1)  # the first of equal ones
        best[s] = d[row, own[s]]
        r = roots(d)
        r[row, own[s]] = np.inf
        n = min(b, len(book) - 1)
        if n:
            near = np.argpartition(r, n - 1, axis=1)[:, :n] if n < r.shape[1] else np.argsort(r, axis=1)
            order = np.argsort(np.take_along_axis(r, near, 1), axis=1, kind="stable")
            near = np.take_along_axis(near, order, 1)
            at[s, :n], lower[s, :n] = near, np.take_along_axis(r, near, 1) * NARROW
            np.put_along_axis(r, near, np.inf, 1)
        outer[s] = r.min(axis=1) * NARROW
    return Lists(own, roots(best) * WIDE, at, lower, outer), best


def moved(s: Lists, drift: np.ndarray) -> Lists:
    """Bounds loosened by the moves of the entries."""
    far = drift.max(initial=0.0) * WIDE
    lower = np.maximum(s.lower - drift[s.at] * WIDE, 0) * NARROW
    outer = np.maximum(s.outer - far, 0) * NARROW
    # a bound may not lie above those behind it: the least of them holds for both
    lower = np.minimum.accumulate(np.minimum(lower, outer[:, None])[:, ::-1], axis=1)[:, ::-1] if lower.shape[1] else lower
    return Lists(s.own, (s.upper + drift[s.own]) * WIDE, s.at, lower, outer)


def assign(x: np.ndarray, book: np.ndarray, s: Lists, want: bool) -> tuple[Lists, np.ndarray, np.ndarray]:
    """(lists, depth, squared distance to the own entry where it was taken; everywhere if ``want``). Depth: how many listed entries
    were read; 0 if the bounds decided, b + 1 if all entries were."""
    b = s.at.shape[1]
    own, upper, at, lower, outer = (a.copy() for a in s)
    depth, best = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype if x.dtype == object else float)
    first = lower[:, 0] if b else outer
    see = np.ones(len(x), bool) if want else upper >= first
    rows = np.flatnonzero(see)
    if len(rows):
        best[rows] = listed(x[rows], book, own[rows][:, None])[:, 0]
        upper[rows] = roots(best[rows]) * WIDE
    rows = rows[upper[rows] >= first[rows]]
    need = (lower[rows] <= upper[rows][:, None]).sum(1)
    need[outer[rows] <= upper[rows]] = b + 1
    depth[rows] = need
    size = 1
    while size < 2 * b:  # rows that read about as many entries together
        mine = rows[(need <= size) & (need > size // 2)]
        size *= 2
        for i in range(0, len(mine), 4096):
            r = mine[i : i + 4096]
            k = int(depth[r].max())
            d = listed(x[r], book, at[r, :k])
            # own entry and those read, by distance and then number
            names, dist = np.column_stack((own[r], at[r, :k])), np.column_stack((best[r], d))
            order = np.lexsort((names, dist.astype(float)), axis=1) if x.dtype != object else np.array([sorted(range(k + 1), key=lambda j: (dist[i][j], names[i][j])) for i in range(len(r))])
            names, dist = np.take_along_axis(names, order, 1), np.take_along_axis(dist, order, 1)
            own[r], best[r] = names[:, 0], dist[:, 0]
            upper[r] = roots(dist[:, 0]) * WIDE
            at[r, :k] = names[:, 1:]
            seen = roots(dist[:, 1:]) * NARROW
            behind = lower[r, k] if k < b else outer[r]
            lower[r, :k] = np.minimum(seen, behind[:, None])
    rows = rows[need == b + 1]
    if len(rows):
        anew, d = full(x[rows], book, b)
        own[rows], upper[rows], at[rows], lower[rows], outer[rows], best[rows] = *anew, d
    return Lists(own, upper, at, lower, outer), depth, best


# ---- tables: one row per vector, its parts as bytes and the state of all parts as bytes


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """Whole-number components padded to ``width``; int64, or Python's where squared distances could leave 52 bits."""
    size = np.diff(np.asarray(col.offsets))
    m = np.zeros((len(col), width))
    m[np.arange(width) < size[:, None]] = np.floor(col.flatten().to_numpy(zero_copy_only=False))
    return m


def _kind(m: np.ndarray, top: float, width: int) -> np.ndarray:
    if fits(top, width):
        return m.astype(np.int64)
    return np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)


def _pack(s: Lists) -> list[bytes]:
    b = s.at.shape[1]
    kind = np.dtype([("own", "<u2"), ("upper", "<f8"), ("outer", "<f8"), ("at", "<u2", (b,)), ("lower", "<f4", (b,))])
    rows = np.zeros(len(s.own), kind)
    rows["own"], rows["upper"], rows["outer"], rows["at"] = s.own, s.upper, s.outer, s.at
    rows["lower"] = np.nextafter(s.lower.astype("<f4"), np.float32(0), dtype=np.float32)  # downwards: still a bound
    raw, size = rows.tobytes(), kind.itemsize
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def _unpack(col: pa.Array, b: int, keep: int) -> Lists:
    kind = np.dtype([("own", "<u2"), ("upper", "<f8"), ("outer", "<f8"), ("at", "<u2", (b,)), ("lower", "<f4", (b,))])
    rows = np.frombuffer(b"".join(col.to_pylist()), kind)
    lower, outer = rows["lower"].astype(float), rows["outer"].copy()
    if keep < b:  # what is cut off goes under the outer bound
        outer = np.minimum(outer, lower[:, keep])
    return Lists(rows["own"].astype(np.int64), rows["upper"].copy(), rows["at"][:, :keep].astype(np.int64), lower[:, :keep], outer)


def _round(batches: Iterator[pa.RecordBatch], books: Books, drift: list[np.ndarray] | None, was: int, b: int, width: int, top: float, want: bool) -> Iterator[pa.RecordBatch]:
    """Assign all parts; without ``drift`` from nothing, else from the lists of the round before."""
    parts = len(books.entries)
    for batch in batches:
        x = _kind(_matrix(batch.column("v"), width * parts), top, width)
        state, error, depth = [], np.zeros(len(x), object if x.dtype == object else np.int64), []
        for p, book in enumerate(books.entries):
            mine = x[:, p * width : (p + 1) * width]
            if drift is None:
                lists, best = full(mine, book, b)
                depth.append(np.zeros(len(x), np.int64))
            else:
                lists, deep, best = assign(mine, book, moved(_unpack(batch.column(f"s{p}"), was, b), drift[p]), want)
                depth.append(deep)
            state.append(lists)
            error = error + (best if x.dtype == object else best.astype(np.int64))
        codes = np.array([s.own for s in state]).T.reshape(len(x), parts)
        yield pa.record_batch([batch.column("id"), batch.column("label"), batch.column("v"), *[pa.array(_pack(s), pa.binary()) for s in state], pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())),
                               pa.array(list(np.array(depth).T.astype(np.int32)), pa.list_(pa.int32())), pa.array([min(int(e), TOP) for e in error], pa.int64())],
                              names=["id", "label", "v", *[f"s{p}" for p in range(parts)], "own", "depth", "error"])


def _sums(batches: Iterator[pa.RecordBatch], parts: int, entries: int, width: int, top: float) -> Iterator[pa.RecordBatch]:
    """Per part position and entry: how many parts it has and their sums, of a task; decimal texts, as sums have no bound."""
    exact = fits(top, width)
    total, count = np.zeros((parts, entries, width), np.int64 if exact else object), np.zeros((parts, entries), np.int64)
    for batch in batches:
        x = _kind(_matrix(batch.column("v"), width * parts), top, width)
        own = batch.column("own").flatten().to_numpy().reshape(len(x), parts)
        for p in range(parts):
            np.add.at(total[p], own[:, p], x[:, p * width : (p + 1) * width])
            count[p] += np.bincount(own[:, p], minlength=entries)
    p, e = np.nonzero(count)
    yield pa.record_batch({"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e], pa.int64()), "sums": pa.array([[str(int(v)) for v in row] for row in total[p, e]], pa.list_(pa.string()))})


def _drift(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    d = after - before
    return roots((d * d).sum(1)) * WIDE if d.size else np.zeros(len(before))


def fit_codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, most: int = MOST_LISTED) -> tuple[DataFrame, Books]:
    """(id, label, own: entry of every part, error: squared distance to them) of every usable vector, and the codebooks."""
    named = vectors.select(F.col(vec_id).alias("_id"), F.col(embedding).alias("_v"), F.col(label).alias("_label"))
    floor = F.transform("v", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))  # larger doubles are whole
    rows = stored(whole(named, "_id", "_v", scale, "_label").withColumn("v", floor), "vectors")
    size = rows.agg(F.max(F.size("v")).alias("w"), F.max(F.array_max(F.transform("v", F.abs))).alias("top"), F.count(F.lit(1)).alias("n")).first()
    width, top = -(-(size.w or 0) // parts), float(np.floor(size.top or 0)) + 1
    seeds = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").toArrow().combine_chunks()
    col = seeds.column("v").combine_chunks()
    start = _kind(_matrix(col.chunk(0) if isinstance(col, pa.ChunkedArray) else col, width * parts), top, width) if size.n else np.zeros((0, width * parts), np.int64)
    books = Books([start[:, p * width : (p + 1) * width].copy() for p in range(parts)])
    k, was, b, drift = len(start), 0, max(0, min(most, len(start) - 1)), None
    kind = "id long, label {}, v array<double>, {}, own array<int>, depth array<int>, error long".format(rows.schema["_label"].dataType.simpleString(), ", ".join(f"s{p} binary" for p in range(parts)))
    now = rows.withColumnRenamed("_label", "label")
    for turn in range(rounds + 1):
        task = lambda bs, a=(books, drift, was, b, width, top, turn == rounds): _round(bs, *a)
        then = stored(now.mapInArrow(task, kind), "assigned")
        discard(now)
        now, was = then, b
        if turn == rounds:
            break
        partial = now.select("v", "own").mapInArrow(lambda bs: _sums(bs, parts, k, width, top), "part int, entry int, n long, sums array<string>")
        each = partial.select("part", "entry", "n", F.posexplode("sums")).groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).cast("string").alias("s"))
        new = [m.copy() for m in books.entries]
        for r in each.toArrow().to_pylist():  # parts * entries * width numbers
            new[r["part"]][r["entry"], r["pos"]] = int(r["s"]) // r["n"]
        drift = [_drift(a, c) for a, c in zip(books.entries, new)]
        books = Books(new)
        if turn:
            by_depth = {r.d: r.n for r in now.select(F.explode("depth").alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most b + 2 rows
            total, kept = sum(by_depth.values()), b
            while kept > 1 and sum(n for d, n in by_depth.items() if d > kept // 2) <= MISSES * total:
                kept //= 2
            b = kept
    return now.select("id", "label", "own", "error"), books


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", **options) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error (summed over equal labels), codebooks_sha256."""
    coded, books = fit_codes(vectors, vec_id, embedding, label, **options)
    by_label = coded.groupBy(F.col("label").alias("_l")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_e"))
    code = F.concat_ws("", F.transform("own", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))))
    total = F.least("_e", F.lit(TOP).cast("decimal(38,0)")).cast("long")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_l")))
    return joined.select(F.col("id").alias("vec_id"), code.alias("code"), "error", total.alias("label_error"), F.lit(books.sha256()).alias("codebooks_sha256"))
