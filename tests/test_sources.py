"""Files, loads, streams and generators."""

import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from lakekit.operators.versioned import VersionedTable
from lakekit.sources import files as S, generate as G
from lakekit.sources.loads import copy_into
from lakekit.sources.schemas import widest
from lakekit.streaming import files as SF


def put(path, text, name="a.csv"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_quote_per_file(spark, new_dir):
    single = put(new_dir(), "id,ingredients,n\nA,'[\"x\", \"y\"]',1\n")
    assert rows(S.read_csv(spark, single, infer=False, quote="'")) == [("A", '["x", "y"]', "1")]
    double = put(new_dir(), '﻿id,address,country\nS1,"Halle 4, Gleis 2, Nord",AU\n')
    assert rows(S.read_csv(spark, double)) == [("S1", "Halle 4, Gleis 2, Nord", "AU")]
    # the wrong quote splits the address
    assert S.read_csv(spark, double, infer=False, quote="'").first()[2] == " Gleis 2"


def test_csv_inference(spark, new_dir):
    path = put(new_dir(), "a,b\n1,x\n2,\n")
    assert [t for _, t in S.read_csv(spark, path).dtypes] == ["int", "string"]
    assert [t for _, t in S.read_csv(spark, path, infer=False).dtypes] == ["string", "string"]


def test_rescued_fields(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2, "c": {"d": 1}, "e": 5}',), ("not json",)], "value string")
    assert rows(S.with_rescued(df, "a int, b string")) == sorted([(1, "x", None), (2, None, '{"c":"{\\"d\\":1}","e":"5"}'), (None, None, '{"_malformed":"not json"}')], key=repr)


def test_rescued_values_of_a_wrong_type(spark):
    df = spark.createDataFrame([('{"a": "one", "b": "x"}',), ('{"a": null, "b": "y"}',), ("",), (None,)], "value string")
    assert rows(S.with_rescued(df, "a int, b string")) == sorted([(None, "x", '{"a":"one"}'), (None, "y", None), (None, None, None), (None, None, None)], key=repr)


def test_stream_rescues_what_its_schema_cannot_hold(spark, new_dir):
    src, kept, out = new_dir("src"), new_dir("schema"), new_dir("out")
    put(src, '{"a": 1}\n', "one.json")
    run = lambda: SF.run_available_now(SF.stream_files(spark, src, "json", schema_dir=kept, rescue=True), out, out + "-checkpoint")
    run()
    put(src, '{"a": 2, "new": "n"}\n{"a": "two"}\nbroken\n', "two.json")
    run()
    want = [(1, None), (2, '{"new":"n"}'), (None, '{"a":"two"}'), (None, '{"_malformed":"broken"}')]
    assert rows(spark.read.parquet(out).select("a", "_rescued_data")) == sorted(want, key=repr)


def test_one_load_of_two_schemas(spark, new_dir):
    src = new_dir("src")
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{src}/one")
    spark.createDataFrame([(2, "b", 0.5)], "id int, v string, w double").write.parquet(f"{src}/two")
    t = VersionedTable(spark, new_dir())
    assert copy_into(t, src, "parquet", merge_schema=True) > 1
    assert rows(t.read().select("id", "v", "w")) == sorted([(1, "a", None), (2, "b", 0.5)], key=repr)
    assert t.history().count() == 1


def test_exported_slices_read_back(spark, new_dir):
    df = spark.range(2000).selectExpr("id", "concat('S', id % 2) as location", "date '2024-01-01' + cast(id % 3 as int) as ts_date", "if(id % 5 = 0, 'PENDING', 'DONE') as state", "1700000000 + id as ts")
    base = new_dir("export")
    path = S.export_slice(df, base, "S1", "2024-01-02")
    back = spark.read.json(path)
    want = df.where("location = 'S1' and ts_date = '2024-01-02'")
    assert rows(back.select("id", "state")) == rows(want.select("id", "state")) and "exported_ts" in back.columns
    path = S.export_corrections(df, base, "S1", "2024-01-02")
    assert rows(spark.read.json(path).select("id", "state")) == rows(want.where("state = 'PENDING'").selectExpr("id", "'CANCELED' as state"))


def test_copy_into_is_idempotent(spark, new_dir):
    src = new_dir("src")
    put(src, "id,v\n1,a\n", "one.csv")
    t = VersionedTable(spark, new_dir())
    opts = {"header": "true"}
    assert copy_into(t, src, "csv", opts) == 1
    assert copy_into(t, src, "csv", opts) == 0
    put(src, "id,v,w\n2,b,c\n", "two.csv")
    with pytest.raises(ValueError, match="not in the table"):
        copy_into(t, src, "csv", opts)
    assert t.read().count() == 1  # the failed load left nothing behind and can be repeated
    assert copy_into(t, src, "csv", opts, merge_schema=True) == 1
    assert rows(t.read()) == sorted([("1", "a", None), ("2", "b", "c")], key=repr)
    put(src, "id,v,w\n3,x,y\n", "three.csv")
    assert copy_into(t, src, "csv", opts, select=["cast(id as int) + 1 as id", "v"]) == 1
    assert ("4", "x", None) in rows(t.read())
    assert [r.operation for r in t.history().collect()] == ["COPY"] * 3


def test_stream_keeps_its_schema(spark, new_dir):
    base = new_dir()
    put(f"{base}/in", '{"id": 1, "items": [{"a": 1}]}\n', "1.json")
    run = lambda: SF.run_available_now(SF.stream_files(spark, f"{base}/in", "json", schema_dir=f"{base}/schema", nested_as_text=True), f"{base}/out", f"{base}/ck")
    run()
    put(f"{base}/in", '{"id": 2, "items": [{"a": 2}], "new": true}\n', "2.json")
    run()
    assert rows(spark.read.parquet(f"{base}/out")) == [(1, '[{"a": 1}]'), (2, '[{"a": 2}]')]


def test_stream_with_rescued_data(spark, new_dir):
    base = new_dir()
    put(f"{base}/in", '{"id": 1, "x": 2}\n', "1.json")
    SF.run_available_now(SF.stream_json_rescued(spark, f"{base}/in", "id int"), f"{base}/out", f"{base}/ck")
    assert rows(spark.read.parquet(f"{base}/out")) == [(1, '{"x":"2"}')]


def test_query_path_and_literal_rows(spark, new_dir):
    path = new_dir()
    S.write_files(S.rows(spark, [(1, "a")], "k int, v string"), path, "json", files=1)
    assert rows(S.query_path(spark, "json", path, "k, v")) == [(1, "a")]
    with pytest.raises(ValueError):
        S.query_path(spark, "json", "x` where 1=1 --")


def test_export_slice_and_corrections(spark, new_dir):
    data = [("SYD01", "2022-01-01", "PENDING", 1640995200, 1), ("SYD01", "2022-01-01", "COMPLETED", 1640995260, 2), ("SYD01", "2022-01-02", "PENDING", 1641081600, 3)]
    df = spark.createDataFrame(data, "location string, ts_date string, state string, ts long, id int")
    base = new_dir()
    got = spark.read.json(S.export_slice(df, base, "SYD01", "2022-01-01"))
    assert rows(got.select("id", "state", "ts")) == [(1, "PENDING", 1640995200), (2, "COMPLETED", 1640995260)]
    assert "exported_ts" in got.columns and "ts_date" not in got.columns
    fix = spark.read.json(S.export_corrections(df, base, "SYD01", "2022-01-01"))
    assert rows(fix.select("id", "state", "ts")) == [(1, "CANCELED", "2022-01-01 00:00:00")]


def test_partitioned_table_prunes(spark, new_dir):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("p"))
    t = S.ctas(spark, "lk_pruned", df, "replace", partition_by=["p"], sort_by=["id"], path=new_dir())
    plan = t.where("p = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and t.where("p = 2").count() == 25
    with pytest.raises(Exception):
        S.ctas(spark, "lk_pruned", df)
    assert S.ctas(spark, "lk_pruned", df.limit(1), "ignore").count() == 100
    spark.sql("drop table lk_pruned")


def test_stable_sample_does_not_depend_on_partitions(spark):
    df = spark.range(10000).toDF("k")
    a, b = S.stable_sample(df, ["k"], 0.05), S.stable_sample(df.repartition(13), ["k"], 0.05)
    assert rows(a) == rows(b) and 380 < a.count() < 620
    assert S.sample(df, 0.05).count() == S.sample(df, 0.05).count()


def test_generated_orders(spark):
    stores = spark.createDataFrame([("SYD01", "AU"), ("AKL01", "NZ")], "store_id string, country string")
    hol = spark.createDataFrame([("NZ", "2023-03-08")], "country string, date string").select("country", F.to_date("date").alias("date"))
    o = G.gen_orders(stores, "2023-03-08", "2023-03-09", ["P1", "P2"], seed=1, holidays=hol).cache()
    assert o.select("id").distinct().count() == o.count()
    per = {(r.store_id, r.d): r for r in o.groupBy("store_id", F.substring("ts", 1, 10).alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ts").alias("slots")).collect()}
    assert all(r.slots == 14 * 6 for r in per.values())
    # 468 orders are expected on a working day, 738 on a holiday
    assert abs(per[("SYD01", "2023-03-08")].n - 468) < 100 and abs(per[("AKL01", "2023-03-08")].n - 738) < 120
    hours = o.select(F.min(F.substring("ts", 12, 2)), F.max(F.substring("ts", 12, 2))).first()
    assert tuple(hours) == ("07", "20")
    share = {r.state: r["count"] / o.count() for r in o.groupBy("state").count().collect()}
    assert abs(share["COMPLETED"] - 0.9) < 0.03 and abs(share["PENDING"] - 0.07) < 0.03
    items = o.select(F.explode("sale_items").alias("i")).select("i.*")
    assert {tuple(r) for r in items.select("size", "cost").distinct().collect()} == {("Small", 5), ("Medium", 7), ("Large", 9)}
    assert items.where("id = 'custom' and ingredients is null or id <> 'custom' and ingredients is not null").isEmpty()
    assert abs(items.where("id = 'custom'").count() / items.count() - 0.3) < 0.04
    again = G.gen_orders(stores.repartition(3), "2023-03-08", "2023-03-09", ["P1", "P2"], seed=1, holidays=hol)
    assert o.exceptAll(again).isEmpty()
    other = G.more_orders(stores, "2023-03-08", ["P1"], batch=1, seed=1)
    assert other.join(o, "id").isEmpty() and other.select("store_id").distinct().count() == 1


def test_generated_customers(spark):
    c = G.gen_customers(spark, 500)
    assert c.columns == ["id", "creation_date", "customer_firstname", "customer_lastname", "country", "customer_email", "address", "gender", "age_group"]
    assert c.where("country not in ('FR', 'USA', 'SPAIN') or gender not in (0, 1) or age_group not between 0 and 10").isEmpty()
    assert c.select("id").distinct().count() == 500


def test_rescue_at_any_depth(spark):
    doc = '{"a":{"b":"x","new":1},"l":[1,"z"],"m":{"k":{"q":"no"},"j":{"q":3}},"o":[{"p":1},{"p":"w","r":2},5],"x.y":5,"n":null}'
    got = spark.createDataFrame([(doc,), ('{"a":7}',), ('{"a":null,"l":[null]}',)], "value string")
    got = [r._rescued_data and json.loads(r._rescued_data) for r in S.with_rescued(got, "a struct<b:int>, l array<int>, m map<string,struct<q:int>>, o array<struct<p:int>>, n int").collect()]
    lost = {"a.b": "x", "a.new": "1", "l[1]": "z", "m.k.q": "no", "o[1].p": "w", "o[1].r": "2", "o[2]": "5", "['x.y']": "5"}
    # a part that Spark gives up as a whole is kept value by value
    assert got[0].items() >= lost.items() and set(got[0]) - set(lost) <= {"l[0]", "o[0].p", "m.j.q"}
    assert got[1:] == [{"a": "7"}, None]


def test_csv_columns_follow_their_own_header(spark, new_dir):
    src, table = new_dir("in"), VersionedTable(spark, new_dir("t"))
    texts = {"a": "id,name\n007,a\n2,b\n", "b": "city,id,name\nBonn,x9,c\n", "c": "\ufeffid,NAME,n\n3,d,1.5\n", "d": "name,id\ne,4\n"}
    os.makedirs(src)
    for name, text in texts.items():
        with open(f"{src}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    assert copy_into(table, src, "csv", options={"header": "true", "inferSchema": "true"}, merge_schema=True) == 4
    got = {(r.id, r.name, r.city, r.n) for r in table.read().collect()}
    assert got == {("007", "a", None, None), ("2", "b", None, None), ("x9", "c", "Bonn", None), ("3", "d", None, 1.5), ("4", "e", None, None)}


def test_csv_schemas_in_three_loads(spark, new_dir):
    src, table = new_dir("in"), VersionedTable(spark, new_dir("t"))
    os.makedirs(src)
    for i, text in enumerate(["id,name\n1,a\n", "more,name,id\n2.5,b,2\n", "id\n3\n"]):
        with open(f"{src}/{i}.csv", "w") as f:
            f.write(text)
        assert copy_into(table, src, "csv", options={"header": "true", "inferSchema": "true"}, merge_schema=True) == 1
    assert {(r.id, r.name, r.more) for r in table.read().collect()} == {(1, "a", None), (2, "b", 2.5), (3, None, None)}


def test_types_widen():
    i, n, d, t = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    dec = T.DecimalType
    assert [widest(i, n), widest(n, d), widest(i, t), widest(T.NullType(), i), widest(T.DateType(), T.TimestampType())] == [n, d, t, i, T.TimestampType()]
    assert widest(dec(10, 2), i) == dec(12, 2) and widest(dec(38, 10), dec(38, 0)) == d and widest(dec(5, 3), dec(7, 1)) == dec(9, 3)
    a, b = T.StructType().add("x", i).add("y", T.ArrayType(i)), T.StructType().add("Y", T.ArrayType(t)).add("z", d)
    assert widest(a, b) == T.StructType().add("x", i).add("y", T.ArrayType(t)).add("z", d)
    assert widest(T.ArrayType(i), i) == t
