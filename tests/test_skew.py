"""Ordered scans: hot keys cut into stretches give what a plain window gives."""

import random

import pytest
from pyspark.sql import functions as F

from lakekit.operators import ml, scd, skew


def brute(rows):
    """rows of (k, s, t, v, reset) -> {(k, s, t): (next s, last v, running count)}"""
    out = {}
    for k in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2]))
        last, run = None, 0
        for i, (_, s, t, v, reset) in enumerate(mine):
            if reset:
                last = None
            elif v is not None:
                last = v
            run += 1 if reset else 0
            out[(k, s, t)] = (mine[i + 1][1] if i + 1 < len(mine) else None, last, run)
    return out


def skewed_rows(n, seed):
    """A third of all rows belong to key 0; few distinct sequence values, so ties occur."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if r.random() < 1 / 3 else r.randrange(1, 40)
        reset = r.random() < 0.05
        rows.append((k, r.randrange(n // 4), i, None if r.random() < 0.6 else f"v{i}", reset))
    return rows


@pytest.mark.parametrize("seed,ranges", [(1, 1), (2, 7), (3, 60)])
def test_scan_equals_brute_force(spark, seed, ranges):
    rows = skewed_rows(3000, seed)
    df = spark.createDataFrame(rows, "k int, s int, t int, v string, reset boolean").withColumn("one", F.col("reset").cast("long"))
    got = skew.ordered_scan(df, ["k"], ["s"], ["t"], lead={"nxt": "s"}, last={"lv": "v"}, running={"run": "one"}, reset="reset", ranges=ranges)
    got = {(r.k, r.s, r.t): (r.nxt, r.lv, r.run) for r in got.collect()}
    assert got == brute(rows)


def test_ranges_are_even_and_few_keys_cross(spark):
    df = spark.createDataFrame(skewed_rows(3000, 4), "k int, s int, t int, v string, reset boolean")
    src = skew.ranged(df, ["k"], ["s", "t"], 30)
    sizes = [r["count"] for r in src.groupBy("_p").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 250
    assert src.where("k = 0").select("_p").distinct().count() >= 8
    assert skew.borders(src, ["k"]).count() <= 60


@pytest.mark.parametrize("tie", ["number", "text"])
@pytest.mark.parametrize("seq", ["one value", "NULL", "own"])
def test_one_key_holds_all_rows(spark, seq, tie):
    n = 2000
    s = {"one value": F.lit(5), "NULL": F.lit(None).cast("int"), "own": F.col("id").cast("int")}[seq]
    t = F.col("id") if tie == "number" else F.lpad(F.col("id").cast("string"), 6, "0")
    df = spark.range(n).select(F.lit(0).alias("k"), s.alias("s"), t.alias("t"), F.col("id"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    sizes = [r["count"] for r in skew.ranged(df, ["k"], ["s", "t"], 20).groupBy("_p").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < n / 5
    got = skew.ordered_scan(df, ["k"], ["s"], ["t"], last={"lv": "v"}, lead={"n": "id"}, ranges=20)
    assert got.count() == n
    assert got.where("lv <> id - id % 7 or lv is null or (n <> id + 1 and n is not null)").isEmpty() and got.where("n is null").count() == 1


def test_three_hundred_hot_keys(spark):
    df = spark.range(6000).select((F.col("id") % 300).alias("k"), F.col("id").alias("s"), F.lit(1).alias("one"))
    got = skew.ordered_scan(df, ["k"], ["s"], lead={"n": "s"}, running={"run": "one"}, ranges=450)
    assert got.where("run <> s div 300 + 1 or (n <> s + 300 and n is not null)").isEmpty()
    assert got.where("n is null").count() == 300


@pytest.mark.parametrize("make", ["string", "struct"])
def test_other_sequence_types(spark, make):
    rows = skewed_rows(2000, 5)
    df = spark.createDataFrame(rows, "k int, s int, t int, v string, reset boolean")
    seq = ["x"]
    df = df.withColumn("x", F.lpad(F.col("s").cast("string"), 6, "0")) if make == "string" else df.withColumn("x", F.col("s"))
    if make == "struct":
        seq = ["x", "t"]
    got = skew.ordered_scan(df, ["k"], seq, ["t"], last={"lv": "v"}, reset="reset", ranges=25)
    want = brute(rows)
    assert {(r.k, r.s, r.t): r.lv for r in got.collect()} == {k: v[1] for k, v in want.items()}


def test_null_keys_and_null_sequences_are_kept(spark):
    rows = [(None, i if i % 5 else None, i, str(i), False) for i in range(500)] + [(1, 1, 1, "a", False)]
    df = spark.createDataFrame(rows, "k int, s int, t int, v string, reset boolean")
    for ranges in (1, 20):
        got = skew.ordered_scan(df, ["k"], ["s"], ["t"], lead={"n": "t"}, ranges=ranges)
        assert got.count() == 501
        assert got.where("n is null").count() == 2  # the last row of both keys


def test_auc_is_exact_when_scores_are_cut(spark):
    r = random.Random(3)
    rows = [(int(r.random() < 0.3), r.randrange(400) / 400) for _ in range(3000)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "y int, s double")
    assert abs(ml.auc(df, "y", "s") - want) < 1e-12
    assert abs(ml.auc(df, "y", "s", ranges=30) - want) < 1e-12


def test_as_of_join_equals_brute_force(spark):
    r = random.Random(8)
    log = [(0 if r.random() < 0.5 else r.randrange(5), i * 3, f"v{i}", r.random() < 0.2) for i in range(400)]
    facts = [(0 if r.random() < 0.5 else r.randrange(6), r.randrange(1300), i) for i in range(800)]
    changes = spark.createDataFrame(log, "k int, s int, v string, gone boolean")
    hist = scd.apply_changes(changes, "k", "s", "gone", except_cols=["s", "gone"], scd_type=2)
    want = {}
    for k, t, i in facts:
        before = [x for x in log if x[0] == k and x[1] <= t]
        newest = max(before, key=lambda x: x[1]) if before else None
        want[i] = None if newest is None or newest[3] else newest[2]
    f = spark.createDataFrame(facts, "k int, t int, i int")
    for ranges in (1, 15):
        got = scd.as_of_join(f, hist, "k", "t", ranges=ranges)
        assert {x.i: x.v for x in got.collect()} == want
        inner = scd.as_of_join(f, hist, "k", "t", how="inner", ranges=ranges)
        assert {x.i for x in inner.collect()} == {i for i, v in want.items() if v is not None}


def test_change_without_sequence_is_kept(spark):
    log = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 5, "c"), (3, 1, "d")], "k int, s int, v string")
    got = {(r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in scd.apply_changes(log, "k", "s", except_cols=["s"], scd_type=2).collect()}
    assert got == {(1, "a", None, None), (2, "b", None, 5), (2, "c", 5, None), (3, "d", 1, None)}


def test_null_key_matches_nothing(spark):
    hist = spark.createDataFrame([(None, "x", 0, None), (1, "y", 0, None)], "k int, v string, __START_AT int, __END_AT int")
    facts = spark.createDataFrame([(None, 5), (1, 5)], "k int, t int")
    assert {(r.k, r.v) for r in scd.as_of_join(facts, hist, "k", "t").collect()} == {(None, None), (1, "y")}


def test_equal_rows_are_spread(spark):
    df = spark.range(10_000, numPartitions=4).select(F.lit("k").alias("k"), F.when(F.col("id") % 5 < 2, 7).otherwise(F.col("id")).alias("s"), F.lit(1).alias("one"))
    cut = skew.ranged(df, ["k"], ["s"], ranges=8)
    sizes = [r["count"] for r in cut.groupBy("_p").count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 2 * 10_000 / 8
    got = skew.ordered_scan(df, ["k"], ["s"], lead={"n": "s"}, running={"run": "one"}, ranges=8)
    rows = sorted((r.run, r.s, r.n) for r in got.collect())
    order = sorted([7] * 4000 + [i for i in range(10_000) if i % 5 >= 2])
    assert rows == [(i + 1, v, w) for i, (v, w) in enumerate(zip(order, [*order[1:], None]))]


def test_ranges_follow_the_bytes(spark, tmp_path):
    spark.range(50_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert skew.ranges_for(df) == few and skew.ranges_for(df, 1000) > few
    assert skew.ranges_for(spark.createDataFrame([(1,)], "a int")) == few
