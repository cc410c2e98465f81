"""The pairs of items most often sold together, exactly, without forming the pairs of every sale.

1. Items are counted, and pairs of the ``heavy`` most frequent ones exactly, as a matrix of at most heavy * heavy counts that tasks
   add up. Its k-th best pair is a threshold: n sales, and items (a, b) for ties. A pair that comes before it has both items in n sales.
2. Items are hashed to ``buckets`` three times. Two buckets are in no fewer sales together than any pair of their items, so a matrix of
   bucket pairs, again added up over the tasks, bounds every pair; a pair stays only if all three bounds reach the threshold. Where so many items
   share a bucket that the mean bound is above the threshold, the matrices are left out.
3. A sale is a list of item numbers, split by blocks of its items where it is long. Tasks form the pairs of their lists, a few million at a time, and send sorted
   gaps between them to the counting tasks, two to four bytes a pair; there are as many of these as the pairs ask for.
4. A pair found in n sales is also found outside any g of them with n - g sales. So very large sales (fewer than n) form no pairs;
   they are asked for the pairs that still may reach the threshold, by joins on (sale, item).

Whatever the bounds let pass is counted exactly. A sale or item that is NULL takes no part; an item counts once per sale. Pairs have
item_a < item_b; ties go to the smaller item_a, then item_b.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize

HASHES = 3
BLOCK = 256
GIANT = 16 * BLOCK  # items; larger sales may be asked instead
AT_ONCE = 1 << 22  # pairs in memory
HOT = 1 << 20  # sales of an item, for which its pairs go to one counting task


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return (v ^ (v >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(20)


def _bucket(code: np.ndarray, h: int, buckets: int) -> np.ndarray:
    return (_mixed(code.astype(np.int64) + (h << 32)) % np.uint64(buckets)).astype(np.int64)


def _together(batches: Iterator[pa.RecordBatch], n: int, h: int | None) -> Iterator[pa.RecordBatch]:
    """In how many sales of the task any two of n numbers stand together: one row per number. With ``h``, of the n buckets of what is given."""
    total = np.zeros((n, n), np.int64)
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            col = b.column("s").slice(at, 2048)
            x = np.zeros((len(col), n), np.float32)
            numbers = col.flatten().to_numpy()
            x[np.repeat(np.arange(len(col)), np.diff(np.asarray(col.offsets))), numbers if h is None else _bucket(numbers, h, n)] = 1
            total += (x.T @ x).astype(np.int64)
    some = np.flatnonzero(total.any(1))
    yield pa.record_batch({"a": pa.array(some, pa.int32()), "n": pa.array(list(total[some]), pa.list_(pa.int64()))})


def _added(group: pa.Table) -> pa.Table:
    rows = group.column("n").combine_chunks()
    rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
    return pa.table({"a": group.column("a")[:1], "n": pa.array([rows.flatten().to_numpy().reshape(len(rows), -1).sum(0)], pa.list_(pa.int64()))})


def _matrix(sets: DataFrame, n: int, h: int | None = None) -> np.ndarray:
    """Sales with both numbers, for numbers below n; ``s``: the numbers of a sale."""
    rows = sets.mapInArrow(lambda bs: _together(bs, n, h), "a int, n array<long>").groupBy("a").applyInArrow(_added, "a int, n array<long>")
    out = np.zeros((n, n), np.int64)
    for r in rows.toArrow().to_pylist():  # at most n rows of n numbers
        out[r["a"]] = r["n"]
    return out


def _numbered(items: DataFrame) -> DataFrame:
    """The rows with numbers ``code`` from 0 on, without gaps; the counts of the partitions come to the driver."""
    items = materialize(items)
    sizes = {r.p: r.n for r in items.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)])])
    start = F.element_at(F.array(*[F.lit(int(v)) for v in starts]), F.spark_partition_id() + 1)
    return materialize(items.withColumn("code", (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + start).cast("int")))


def _packed(v: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, first bytes first: the zeros stand together. The first byte of all is this width."""
    width = next(w for w in (1, 2, 4, 8) if int(v.max()) < 1 << 8 * w)
    return bytes([width]) + v.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1).T.tobytes(), f"<u{b[0]}").astype(np.int64)


def _merged(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(times, at) if len(at) else times


def _send(batches: Iterator[pa.RecordBatch], n: int, parts: int, hot: dict[int, int], bound: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The pairs of every list as a * n + b (a < b) with how often they come, sorted, by number of the counting task."""
    codes, shares = np.array(sorted(hot), np.int64), np.array([hot[c] for c in sorted(hot)], np.int64)
    for b in batches:
        col = b.column("code")
        sizes = np.diff(np.asarray(col.offsets)).astype(np.int64)
        code, side, two = col.flatten().to_numpy().astype(np.int64), b.column("side").flatten().to_numpy(), b.column("two").to_numpy(zero_copy_only=False)
        ends, total = np.cumsum(sizes), np.cumsum(sizes * (sizes - 1) // 2)
        first = 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + AT_ONCE, "right")))
            lo, hi, m = ends[first] - sizes[first], ends[last - 1], sizes[first:last]
            row = np.repeat(np.arange(last - first), m)
            order = np.lexsort((code[lo:hi], row))
            c, d = code[lo:hi][order], side[lo:hi][order]
            follow = np.repeat(np.cumsum(m), m) - 1 - np.arange(hi - lo)
            left = np.repeat(np.arange(hi - lo), follow)
            right = np.arange(len(left)) - np.repeat(np.cumsum(follow) - follow, follow) + left + 1
            keep = ~two[first:last][row[left]] | (d[left] != d[right])
            x, y = c[left[keep]], c[right[keep]]
            for h, enough in enumerate(bound):
                keep = enough[_bucket(x, h, len(enough)), _bucket(y, h, len(enough))]
                x, y = x[keep], y[keep]
            keys, times = _merged(x * n + y, np.ones(len(x), np.int64))
            if len(keys):
                x, y = np.divmod(keys, n)
                if hot:
                    at = np.searchsorted(codes, x).clip(max=len(codes) - 1)
                    share = np.where(codes[at] == x, shares[at], 1).astype(np.uint64)
                    x = x + n * (_mixed(y) % share).astype(np.int64)
                p = _mixed(x) % np.uint64(parts)
                order = np.argsort(p, kind="stable")
                keys, times, p = keys[order], times[order], p[order]
                at = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
                cut = list(zip(at, [*at[1:], len(p)]))
                gaps = [_packed(np.diff(keys[i:j], prepend=0)) for i, j in cut]
                yield pa.record_batch({"p": pa.array(p[at].astype(np.int32)), "gaps": pa.array(gaps, pa.binary()), "times": pa.array([_packed(times[i:j]) for i, j in cut], pa.binary())})
            first = last


def _count(batches: Iterator[pa.RecordBatch], n: int, need: int) -> Iterator[pa.RecordBatch]:
    """Pairs found in ``need`` lists or more; a pair's rows are all in one task."""
    keys, times, more, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    for b in batches:
        for gaps, t in zip(b.column("gaps").to_pylist(), b.column("times").to_pylist()):
            more.append((np.cumsum(_unpacked(gaps)), _unpacked(t)))
            waiting += len(more[-1][0])
            if waiting >= AT_ONCE:
                keys, times = _merged(np.concatenate([keys, *[k for k, _ in more]]), np.concatenate([times, *[t for _, t in more]]))
                more, waiting = [], 0
    keys, times = _merged(np.concatenate([keys, *[k for k, _ in more]]), np.concatenate([times, *[t for _, t in more]]))
    keys, times = keys[times >= need], times[times >= need]
    for i in range(0, len(keys), 1 << 16):
        x, y = np.divmod(keys[i : i + (1 << 16)], n)
        yield pa.record_batch({"a": pa.array(x, pa.int32()), "b": pa.array(y, pa.int32()), "n": pa.array(times[i : i + (1 << 16)], pa.int64())})


def top_pairs(items: DataFrame, sale: str, item: str, k: int = 20, heavy: int = 256, buckets: int = 512, largest: int = 1000) -> DataFrame:
    """item_a, item_b, n_sales of the k pairs found in most sales."""
    spark = items.sparkSession
    rows = materialize(items.select(F.col(sale).alias("s"), F.col(item).alias("i")).where("s is not null and i is not null").distinct())
    count = rows.groupBy("i").agg(F.count(F.lit(1)).alias("c"))
    names = [r.i for r in count.orderBy(F.desc("c"), "i").limit(heavy).collect()]
    empty = spark.createDataFrame([], f"item_a {rows.schema['i'].dataType.simpleString()}, item_b {rows.schema['i'].dataType.simpleString()}, n_sales long")
    if not names:
        return empty
    number = spark.createDataFrame(list(enumerate(names)), f"x int, i {rows.schema['i'].dataType.simpleString()}")
    both = _matrix(rows.join(F.broadcast(number), "i").groupBy("s").agg(F.collect_set("x").alias("s_")).select(F.col("s_").alias("s")), len(names))
    x, y = np.nonzero(np.triu(both, 1))
    known = sorted((-int(both[a, b]), *sorted((names[a], names[b]))) for a, b in zip(x, y))
    least, tie = (-known[k - 1][0], known[k - 1][1:]) if len(known) >= k else (1, None)

    items = _numbered(count.where(F.col("c") >= least))
    n_items = items.count()
    size = materialize(rows.groupBy("s").agg(F.count(F.lit(1)).alias("n")))
    n = F.col("n").cast("double")
    most, sum_pairs, squares = size.agg(F.max("n"), F.sum(n * (n - 1) / 2), F.sum(n * n)).first()
    coded = rows.join(items.select("i", "code"), "i").select("s", "code")
    giants, asked = None, 0
    if most > GIANT and least > 1:
        giants = materialize(size.where(F.col("n") > GIANT).orderBy(F.desc("n"), "s").limit(min(least - 1, largest)).select("s"))
        asked = giants.count()
    rest = coded.join(F.broadcast(giants), "s", "left_anti") if asked else coded
    x, y = F.lit(0), F.lit(0)
    if most > BLOCK:
        # an item of block z meets every other block j: its rows are (smaller, larger) of z and j
        blocks = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
        rest = rest.join(size.where(F.col("n") > BLOCK), "s", "left").withColumn("z", F.pmod(F.xxhash64(F.lit("block"), "code"), blocks).cast("int"))
        rest = rest.select("s", "code", "z", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"))
        x, y = F.least("z", "j"), F.greatest("z", "j")
        rest = rest.withColumn("side", (F.col("z") > F.col("j")).cast("int"))
    else:
        rest = rest.withColumn("side", F.lit(0))
    lists = rest.groupBy("s", x.alias("x"), y.alias("y")).agg(F.collect_list(F.struct("code", "side")).alias("l")).select((F.col("x") != F.col("y")).alias("two"), F.col("l.code").alias("code"), F.col("l.side").alias("side"))
    bound = []
    if squares < float(least) * buckets * buckets:
        lists = materialize(lists)
        bound = [_matrix(lists.select(F.col("code").alias("s")), buckets, h) + asked >= least for h in range(HASHES)]
    hot = {r.code: int(r.c // HOT) + 1 for r in items.where(F.col("c") > HOT).select("code", "c").collect()}  # at most a row for a million rows of input
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(sum_pairs // (AT_ONCE // 2)) + 1)
    sent = lists.mapInArrow(lambda bs: _send(bs, n_items, parts, hot, bound), "p int, gaps binary, times binary")
    need = least - asked
    seen = sent.repartition(parts, "p").mapInArrow(lambda bs: _count(bs, n_items, need), "a int, b int, n long")
    if asked:
        seen = materialize(seen)
        g = materialize(coded.join(F.broadcast(giants), "s", "left_semi").select("s", F.col("code").alias("a")))
        more = seen.select("a", "b").join(g, "a").join(g.withColumnRenamed("a", "b"), ["s", "b"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        seen = seen.unionByName(more).groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    name = lambda c: items.select(F.col("code").alias(c), F.col("i").alias(f"i_{c}"))
    named = seen.join(name("a"), "a").join(name("b"), "b")
    return named.select(F.least("i_a", "i_b").alias("item_a"), F.greatest("i_a", "i_b").alias("item_b"), F.col("n").alias("n_sales")).orderBy(F.desc("n_sales"), "item_a", "item_b").limit(k)
