"""Versioned datasets: the life of a small store table, and properties of the change functions."""

import os
import glob
import random

import pytest
from pyspark.sql import functions as F

from lakekit.operators import changes as C
from lakekit.operators.versioned import VersionedTable

DDL = "id string, name string, city string"
STORES = [("AKL01", "Airport", "Auckland"), ("AKL02", "Centre", "Auckland"), ("BNE02", "River", "Brisbane"), ("MEL02", "Docks", "Melbourne")]


@pytest.fixture
def stores(spark):
    return spark.createDataFrame(STORES, DDL)


def bag(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_life_of_a_table(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir(), key="id")
    t.add_column("store_country", "string")
    t.update({"store_country": "case when id in ('BNE02') then 'AUS' when id in ('AKL01', 'AKL02') then 'NZL' end"})
    assert ("MEL02", None) in bag(t.read(), "id", "store_country")
    t.update({"store_country": "'AUS'"}, "id = 'MEL02'")
    src = spark.createDataFrame([("ADL01", "New", "Adelaide", "AUS"), ("AKL02", "Centre 2", "Auckland", "NZL")], DDL + ", store_country string")
    t.merge(src, "id")
    t.comment_column("id", "unique id")
    t.rename_column("id", "store_id")
    assert t.read().columns == ["store_id", "name", "city", "store_country"]
    assert t.read(4).columns[0] == "id"
    assert t.describe().first().comment == "unique id"
    assert bag(t.read().groupBy("store_country").agg(F.count("store_id"))) == [("AUS", 3), ("NZL", 2)]
    assert [r.version for r in t.history().collect()] == list(range(6, -1, -1))
    t.append(spark.createDataFrame([("SYD02", "Bay")], "store_id string, name string"))
    assert bag(t.version_anti_join(6, "store_id"), "store_id") == [("SYD02",)]
    t.enable_change_feed()
    t.update({"name": "'Terminal'"}, "store_id = 'AKL01'")
    t.delete("store_id = 'BNE02'")
    feed = bag(t.changes(9), "store_id", "name", "_change_type", "_commit_version")
    assert feed == sorted([("AKL01", "Airport", "update_preimage", 9), ("AKL01", "Terminal", "update_postimage", 9), ("BNE02", "River", "delete", 10)], key=repr)
    assert bag(t.changes(9, 9), "_change_type") == [("update_postimage",), ("update_preimage",)]
    with pytest.raises(ValueError):
        t.changes(3)
    with pytest.raises(ValueError):
        t.read(version=99)


def test_renamed_key_in_the_feed(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir(), key="id", change_feed=True)
    t.update({"name": "'x'"}, "id = 'AKL01'")
    t.rename_column("id", "store_id")
    t.delete("store_id = 'AKL01'")
    assert bag(t.changes(1), "store_id", "_change_type", "_commit_version") == [("AKL01", "delete", 3), ("AKL01", "update_postimage", 1), ("AKL01", "update_preimage", 1)]


def test_constraint_rejects_and_writes_nothing(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir())
    t.not_null("id")
    before = t.version
    with pytest.raises(ValueError, match="constraint"):
        t.append(spark.createDataFrame([(None, "x", "y")], DDL))
    assert t.version == before and t.read().count() == 4
    assert len([f for f in os.listdir(f"{t.path}/data") if f.startswith("_write=")]) == 1  # the refused rows are gone
    with pytest.raises(ValueError):
        t.add_constraint("short", "length(name) < 3")


def test_null_predicate_changes_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "k int, v string")
    assert bag(C.update(df, {"k": "k + 10"}, "v = 'a'")) == [(1, None), (12, "a")]
    assert bag(C.delete(df, "v = 'a'")) == [(1, None)]
    assert bag(C.delete(df, "v <> 'a'")) == [(1, None), (2, "a")]
    assert C.delete(df).isEmpty()


def test_update_sees_the_old_row(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert bag(C.update(df, {"a": "b", "b": "a"})) == [(2, 1)]


def test_only_touched_parts_are_rewritten(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir(), key="id", partition_by="city", change_feed=True)
    t.update({"name": "'x'"}, "id = 'AKL01'")
    old, new = t._commit(0).parts, t._commit(1).parts
    assert len(set(old) & set(new)) == 2 and len(new) == 3
    files = glob.glob(f"{t.path}/data/_write=1-*/*")
    assert [f.split("/")[-1] for f in files if "city" in f] == ["city=Auckland"]
    t.update({"name": "'y'"}, "id = 'nobody'")
    assert t._commit().parts == new
    t.delete("city = 'Brisbane'")
    assert bag(t.changes(1), "id", "_change_type") == [("AKL01", "update_postimage"), ("AKL01", "update_preimage"), ("BNE02", "delete")]
    assert t.read().count() == 3 and t.read(0).count() == 4


def test_odd_partition_values(spark, new_dir):
    rows = [("a b", 1), ("c/d", 2), ("e%f", 3), ("g=h", 4), (None, 5)]
    t = VersionedTable.create(spark.createDataFrame(rows, "p string, v int"), new_dir(), partition_by="p")
    assert bag(t.read()) == sorted(rows, key=repr)
    t.update({"v": "v + 10"}, "p in ('a b', 'c/d') or p is null")
    t.delete("p = 'g=h'")
    assert bag(t.read()) == sorted([("a b", 11), ("c/d", 12), ("e%f", 3), (None, 15)], key=repr)


def test_merge_rules(spark):
    target = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, v string")
    assert bag(C.merge(target, source, "k")) == sorted([(1, "x"), (1, "x"), (2, "b"), (None, "n"), (3, "y"), (None, "z")], key=repr)
    assert bag(C.merge(target, source, "k", matched=None)) == sorted([(1, "a"), (1, "a2"), (2, "b"), (None, "n"), (3, "y"), (None, "z")], key=repr)
    assert bag(C.merge(target, source, "k", matched={"v": "concat(t.v, s.v)"}, not_matched=None)) == sorted([(1, "ax"), (1, "a2x"), (2, "b"), (None, "n")], key=repr)
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="more than one"):
        C.merge(target, twice, "k")
    fresh = spark.createDataFrame([(9, "x"), (9, "y")], "k int, v string")
    assert C.merge(target, fresh, "k").count() == 6


def test_merge_twice_is_merge_once(spark):
    r = random.Random(1)
    target = spark.createDataFrame([(i, f"t{i}", r.randrange(9)) for i in range(200)], "k int, v string, n int")
    source = spark.createDataFrame([(r, f"s{r}", 0) for r in range(150, 260)], "k int, v string, n int")
    once = C.merge(target, source, "k")
    assert bag(C.merge(once, source, "k")) == bag(once) and once.count() == 260


def test_diff_then_apply(spark):
    r = random.Random(2)
    mk = lambda: [(k, None if r.random() < 0.2 else r.randrange(3)) for k in range(300) if r.random() < 0.8]
    a, b = spark.createDataFrame(mk(), "k int, v int"), spark.createDataFrame(mk(), "k int, v int")
    d = C.diff(a, b, "k")
    assert bag(C.apply_diff(a, d, "k")) == bag(b)
    assert C.diff(a, a, "k").isEmpty()
    n = {x._change_type: x["count"] for x in d.groupBy("_change_type").count().collect()}
    assert n["update_preimage"] == n["update_postimage"]


def test_diff_without_key(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (3,)], "v int")
    assert bag(C.diff(a, b, None)) == [(1, "delete"), (2, "delete"), (3, "insert")]


def test_clones(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir(), key="id")
    t.rename_column("name", "title")
    t.delete("id = 'AKL01'")
    deep, flat = t.clone(new_dir(), version=1), t.clone(new_dir(), deep=False)
    assert deep.read().count() == 4 and deep.read().columns == ["id", "title", "city"]
    assert [r.operation for r in deep.history().collect()] == ["CLONE"]
    t.delete()
    flat.append(stores.limit(1).toDF("id", "title", "city"))
    assert t.read().isEmpty() and flat.read().count() == 4 and deep.read().count() == 4
    assert flat.detail().first().num_parts == 2
    assert not glob.glob(f"{flat.path}/data/_write=0*")


def test_second_writer_of_a_version_fails(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir())
    stale = t._commit()
    t.append(stores)
    with pytest.raises(Exception, match="(?i)exist"):
        t._write(stale, stores, stale.parts, "APPEND", {})
    assert t.read().count() == 8


def test_read_as_of_time(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir(), key="id", change_feed=True)
    t.delete("id = 'AKL01'")
    t.delete("id = 'AKL02'")
    ts = {r.version: r.s for r in t.history().select("version", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("s")).collect()}
    assert [t.read(timestamp=ts[v]).count() for v in range(3)] == [4, 3, 2]
    assert bag(t.changes(start_ts=ts[1], end_ts=ts[1]), "id") == [("AKL01",)]
    with pytest.raises(ValueError):
        t.read(timestamp="2001-01-01")


def test_append_by_position_and_unknown_column(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir())
    t.append(spark.createDataFrame([("X", "c")], "a string, b string"), ["id", "city"])
    assert ("X", None, "c") in bag(t.read())
    with pytest.raises(ValueError, match="not in the table"):
        t.append(stores.withColumn("extra", F.lit(1)))
    t.append(stores.withColumn("extra", F.lit(1)), merge_schema=True)
    assert t.read().where("extra is null").count() == 5


def test_replace_whole_content_with_other_columns(spark, new_dir, stores):
    t = VersionedTable.create(stores, new_dir())
    t.commit(stores.select("id").withColumn("n", F.lit(1)), overwrite_schema=True)
    assert t.read().columns == ["id", "n"] and t.read(0).columns == ["id", "name", "city"]


def test_empty_partition_value_stays_empty(spark, new_dir):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "="), (4, "=x"), (5, "a b/c")], "k int, p string")
    t = VersionedTable.create(df, new_dir(), key="k", partition_by="p")
    assert {(r.k, r.p) for r in t.read().collect()} == {(1, ""), (2, None), (3, "="), (4, "=x"), (5, "a b/c")}
    t.update({"k": "k + 10"}, where="p = ''")
    t.replace_parts(spark.createDataFrame([(30, "=")], "k int, p string"), ["="])
    assert {(r.k, r.p) for r in t.read().collect()} == {(11, ""), (2, None), (30, "="), (4, "=x"), (5, "a b/c")}
    assert {(r.k, r.p) for r in t.read(version=0).where("p = ''").collect()} == {(1, "")}


def test_equal_rows_are_no_change(spark):
    old = [(1, "a")] * 3 + [(1, "b")] * 3 + [(2, "x"), (3, "y"), (None, "n")]
    new = [(1, "a")] * 3 + [(1, "b")] * 3 + [(1, "c"), (2, "z"), (4, "q"), (None, "n")]
    df = lambda rows: spark.createDataFrame(rows, "k int, v string")
    got = sorted(tuple(r) for r in C.diff(df(old), df(new), "k").collect())
    assert got == [(1, "c", "insert"), (2, "x", "update_preimage"), (2, "z", "update_postimage"), (3, "y", "delete"), (4, "q", "insert")]
    fewer = sorted(tuple(r) for r in C.diff(df(new), df([(1, "a"), (1, "b"), (1, "c")]), "k").where("k = 1").collect())
    assert fewer == [(1, "a", "delete")] * 2 + [(1, "b", "delete")] * 2


def test_diff_compares_maps(spark):
    df = lambda m: spark.createDataFrame([(1, m)], "k int, m map<string,int>")
    assert C.diff(df({"a": 1, "b": 2}), df({"b": 2, "a": 1}), "k").isEmpty()
    assert C.diff(df({"a": 1}), df({"a": 2}), "k").count() == 2
