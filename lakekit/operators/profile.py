"""Table profiles and distributions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _long(one: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One aggregate row with ``<field>_<i>`` columns to one row per column."""
    items = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}_{i}").alias(f) for f in fields]) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*items)).alias("x")).select("x.*")


def profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = True) -> DataFrame:
    """count, nulls, distinct, mean, stddev, min, quartiles and max of numeric columns in one aggregate.

    ``approximate`` uses sketches of fixed size for distinct counts and quartiles; the exact quartiles take a few passes, see
    ``exact_quantiles``.
    """
    cols = list(columns or numeric_columns(df))
    aggs = []
    probabilities = [0.25, 0.5, 0.75]
    exact = {} if approximate else exact_quantiles(df, cols, probabilities)
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        q = F.percentile_approx(x, probabilities, 10000) if approximate else F.array(*[F.lit(v).cast("double") for v in exact[c]])
        nd = F.approx_count_distinct(c) if approximate else F.count_distinct(c)
        aggs += [
            F.count(c).alias(f"count_{i}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"), nd.alias(f"distinct_{i}"),
            F.avg(x).alias(f"mean_{i}"), F.stddev_samp(x).alias(f"stddev_{i}"), F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"), q.alias(f"q_{i}"),
        ]
    one = df.agg(*aggs)
    one = one.select("*", *[F.col(f"q_{i}")[k].alias(f"{n}_{i}") for i in range(len(cols)) for k, n in enumerate(["q1", "median", "q3"])])
    return _long(one, cols, ["count", "nulls", "distinct", "mean", "stddev", "min", "q1", "median", "q3", "max"])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10_000, few: int = 100_000) -> dict[str, list[float | None]]:
    """Exact quantiles of every column with linear interpolation between neighbours, as ``percentile`` gives them; None without values.

    Every wanted place in the order has an open range of values it lies in. A sketch of the rows inside gives two values around the
    place, exact counts tell which side of them it is on, and the range shrinks to some ``4 / accuracy`` of its rows a pass, whatever their distribution;
    a value that many rows share is found by its count. When at most ``few`` rows are inside they are sorted in one aggregate. All columns
    and places share the passes; memory does not depend on rows or distinct values. NaN is the largest value.
    """
    x = [F.col(c).cast("double") for c in columns]
    total = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(x)]).first()
    places = [[p * (n - 1) for p in probabilities] if n else [] for n in total]
    todo = {(i, r): (None, None, 0, total[i]) for i, ps in enumerate(places) for p in ps for r in (math.floor(p), math.ceil(p))}
    found: dict[tuple[int, int], float] = {}

    def inside(i: int, lo: float | None, hi: float | None):
        return x[i].isNotNull() & (F.lit(True) if lo is None else x[i] > F.lit(lo)) & (F.lit(True) if hi is None else x[i] < F.lit(hi))

    while todo:
        small = [t for t, s in todo.items() if s[3] <= few]
        if small:
            picks = [F.sort_array(F.collect_list(F.when(inside(t[0], *todo[t][:2]), x[t[0]])))[t[1] - todo[t][2]] for t in small]
            found |= zip(small, df.agg(*[p.alias(f"v{k}") for k, p in enumerate(picks)]).first())
        todo = {t: s for t, s in todo.items() if s[3] > few}
        if not todo:
            break
        at = {t: (t[1] - s[2] + 0.5) / s[3] for t, s in todo.items()}
        sides = [[max(0.0, f - 2 / accuracy), min(1.0, f + 2 / accuracy)] for f in at.values()]
        near = df.agg(*[F.percentile_approx(F.when(inside(t[0], *s[:2]), x[t[0]]), side, accuracy).alias(f"q{k}") for k, ((t, s), side) in enumerate(zip(todo.items(), sides))]).first()
        counts = []
        for k, ((i, _), (lo, hi, _, _)) in enumerate(todo.items()):
            (a, b), v, here = map(F.lit, near[k]), x[i], inside(i, lo, hi)
            counts.append(F.array(F.count_if(here & (v < a)), F.count_if(here & (v == a)), F.count_if(here & (v > a) & (v < b)), F.count_if(here & (v > a) & (v == b))).alias(f"c{k}"))
        counted = df.agg(*counts).first()
        for k, (t, (lo, hi, below, n)) in enumerate(list(todo.items())):
            (a, b), (under, at_a, between, at_b), rank = near[k], counted[k], t[1] - below
            if rank < under:
                todo[t] = (lo, a, below, under)
            elif rank < under + at_a:
                found[t] = a
            elif rank < under + at_a + between:
                todo[t] = (a, b, below + under + at_a, between)
            elif rank < (upto := under + at_a + between + at_b):
                found[t] = b
            else:
                todo[t] = (b, hi, below + upto, n - upto)
        todo = {t: s for t, s in todo.items() if t not in found}

    def value(i: int, p: float) -> float:
        low, high = math.floor(p), math.ceil(p)
        a, b = found[i, low], found[i, high]
        return a if low == high or a == b else (high - p) * a + (p - low) * b

    return {c: [value(i, p) for p in places[i]] or [None] * len(probabilities) for i, c in enumerate(columns)}


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, one pass."""
    cols = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(cols)])
    return _long(one, cols, ["missing"])


def _moments(batches: Iterator[pa.RecordBatch], first: Sequence[int], second: Sequence[int], pivot: Sequence[float]) -> Iterator[pa.RecordBatch]:
    """Sums over the rows of a task for every pair of columns, each over the rows that have both: six matrix products a batch."""
    own = list(first) == list(second)
    shape = (len(first), len(second))
    n, bad, a, b, aa, bb, ab = (np.zeros(shape) for _ in range(7))

    def side(batch: pa.RecordBatch, ids: Sequence[int]) -> tuple[np.ndarray, ...]:
        raw = np.stack([batch.column(f"c{i}").to_numpy(zero_copy_only=False) for i in ids], 1)
        there = np.stack([batch.column(f"c{i}").is_valid().to_numpy(zero_copy_only=False) for i in ids], 1)
        fine = there & np.isfinite(raw)
        v = np.where(fine, raw - np.array([pivot[i] for i in ids]), 0.0)
        return v, there.astype(float), (there & ~fine).astype(float)

    for whole in batches:
        for start in range(0, whole.num_rows, 4096):
            batch = whole.slice(start, 4096)
            x, mx, ox = side(batch, first)
            y, my, oy = (x, mx, ox) if own else side(batch, second)
            n += mx.T @ my
            ab += x.T @ y
            a += x.T @ my
            aa += (x * x).T @ my
            if not own:
                b += mx.T @ y
                bb += mx.T @ (y * y)
            if ox.any() or oy.any():
                bad += ox.T @ my + mx.T @ oy
    if own:
        b, bb = a.T, aa.T
    for i, c in enumerate(first):
        pick = np.flatnonzero((np.array(second) > c) & (n[i] > 0))
        if len(pick):
            cols = {"i": np.full(len(pick), c, np.int32), "j": np.array(second, np.int32)[pick], **{k: m[i][pick] for k, m in zip(("n", "bad", "a", "b", "aa", "bb", "ab"), (n, bad, a, b, aa, bb, ab))}}
            yield pa.record_batch({k: pa.array(v) for k, v in cols.items()})


def correlations(df: DataFrame, columns: Sequence[str] | None = None, width: int = 1024) -> DataFrame:
    """Pearson correlation of every pair of numeric columns (a < b in the given order), each over the rows that have both values.

    One pass over the rows for up to ``width`` columns: tasks add up matrix products and send one row of sums per pair, which
    are added with map-side combining. Wider tables are cut into blocks of half that width and read once per pair of blocks, only its
    columns. Values are taken relative to one value of their column, which keeps the sums exact enough. NULL where
    fewer than two rows have both values or one of them does not vary; NaN where a value is infinite or NaN.
    """
    cols = list(columns or numeric_columns(df))
    spark, k = df.sparkSession, len(cols)
    plain = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    some = plain.limit(1000).agg(F.lit(1), *[F.first(f"c{i}", True) for i in range(k)]).first()[1:]
    pivot = [v if v is not None and math.isfinite(v) else 0.0 for v in some]
    block = max(1, k if k <= width else width // 2)
    blocks = [range(i, min(k, i + block)) for i in range(0, k, block)]
    ddl = "i int, j int, n double, bad double, a double, b double, aa double, bb double, ab double"
    sums = spark.createDataFrame([], ddl)
    for p, one in enumerate(blocks):
        for two in blocks[p:]:
            part = plain.select(*[f"c{i}" for i in sorted({*one, *two})])
            got = part.mapInArrow(lambda bs, u=list(one), v=list(two): _moments(bs, u, v, pivot), ddl)
            sums = got if k <= width else sums.unionByName(got)
    s = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "bad", "a", "b", "aa", "bb", "ab")])
    u, v = F.col("n") * F.col("aa") - F.col("a") * F.col("a"), F.col("n") * F.col("bb") - F.col("b") * F.col("b")
    r = F.when(F.col("bad") > 0, F.lit(float("nan"))).when((u > 0) & (v > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("n") * F.col("ab") - F.col("a") * F.col("b")) / (F.sqrt(u) * F.sqrt(v)))))
    names = spark.createDataFrame(list(enumerate(cols)), "k int, name string")
    pairs = names.where(F.col("k") < k - 1).select(F.col("k").alias("x"), F.col("name").alias("a"), F.explode(F.sequence(F.col("k") + 1, F.lit(k - 1))).alias("y"))
    pairs = pairs.join(names.select("k", F.col("name").alias("b")), F.col("y") == F.col("k")).drop("k")
    known = s.select("i", "j", r.alias("corr"))
    return pairs.join(known, (F.col("x") == F.col("i")) & (F.col("y") == F.col("j")), "left").select("a", "b", "corr")


def low_variance(df: DataFrame, columns: Sequence[str] | None = None, limit: float = 0.0) -> DataFrame:
    """Population variance per column with a flag for those at or below the limit."""
    cols = list(columns or numeric_columns(df))
    one = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(f"variance_{i}") for i, c in enumerate(cols)])
    return _long(one, cols, ["variance"]).withColumn("low", F.col("variance") <= limit)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per bin of equal width; bin 0 lies below ``low``, bin ``bins + 1`` at or above ``high``."""
    x = F.col(column).cast("double")
    return df.where(x.isNotNull()).groupBy(F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
