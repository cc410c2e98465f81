"""Sources and sinks."""

from __future__ import annotations

import uuid

from ..operators.versioned import VersionedTable
from ..sources import files as S, generate as G
from ..sources.loads import copy_into, list_files
from ..streaming import files as SF
from .registry import F, load, query, workdir

CUSTOMER_SQL = "select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment from customer"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus"]
ORDER_SQL = "select o_orderkey, o_custkey, o_orderstatus from orders"


def _table(prefix: str) -> str:
    return f"lk_{prefix}_{uuid.uuid4().hex[:10]}"


@query("s01_read_json", CUSTOMER_SQL)
def s01(spark, d):
    path = workdir(spark, "s01")
    S.write_files(load(spark, d, "customer"), path, "json")
    return S.read_json(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("s02_read_csv_infer", CUSTOMER_SQL)
def s02(spark, d):
    path = workdir(spark, "s02")
    S.write_files(load(spark, d, "customer"), path, "csv", options={"header": "true"})
    df = S.read_csv(spark, path)
    return df.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("long").alias("c_nationkey"), "c_acctbal", "c_mktsegment")


@query("s03_read_csv_quote", "select cast(p_partkey as varchar) as p_partkey, p_name || '; it''s ' || p_brand as label from part")
def s03(spark, d):
    path = workdir(spark, "s03")
    df = load(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit("; it's "), "p_brand").alias("label"))
    S.write_files(df, path, "csv", options={"header": "true", "sep": ";", "quote": "'", "escape": "'"})
    return S.read_csv(spark, path, infer=False, sep=";", quote="'")


@query("s04_read_parquet", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def s04(spark, d):
    return S.read_parquet(spark, f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


@query("s05_query_path", "select s_suppkey, s_name, s_acctbal from supplier")
def s05(spark, d):
    return S.query_path(spark, "parquet", f"{d}/supplier.parquet", "s_suppkey, s_name, s_acctbal")


@query("s06_read_table", ORDER_SQL)
def s06(spark, d):
    name = _table("s06")
    S.save_table(load(spark, d, "orders").select(*ORDER_COLS), name, path=workdir(spark, "s06"))
    return spark.table(name)


@query("s07_json_text_to_columns", "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events")
def s07(spark, d):
    return S.json_text_to_df(load(spark, d, "events"), "props", "k int", ["event_id"])


@query("s08_copy_into_once", ORDER_SQL)
def s08(spark, d):
    src, table = workdir(spark, "s08src"), VersionedTable(spark, workdir(spark, "s08"))
    o = load(spark, d, "orders").select(*ORDER_COLS)
    S.write_files(o.where("o_orderstatus = 'F'"), f"{src}/first", "json")
    schema = "o_orderkey long, o_custkey long, o_orderstatus string"
    copy_into(table, src, "json", schema=schema, glob="*.json")
    copy_into(table, src, "json", schema=schema, glob="*.json")
    S.write_files(o.where("o_orderstatus <> 'F'"), f"{src}/second", "json")
    copy_into(table, src, "json", schema=schema, glob="*.json")
    return table.read()


@query("s09_copy_into_select", "select s_suppkey as id, upper(s_name) as name from supplier")
def s09(spark, d):
    table = VersionedTable(spark, workdir(spark, "s09"))
    copy_into(table, f"{d}/supplier.parquet", "parquet", select=["s_suppkey as id", "upper(s_name) as name"])
    return table.read()


@query("s10_copy_into_merge_schema", "select c_custkey, c_name, case when c_acctbal >= 0 then c_mktsegment end as c_mktsegment from customer")
def s10(spark, d):
    src, table = workdir(spark, "s10src"), VersionedTable(spark, workdir(spark, "s10"))
    c = load(spark, d, "customer")
    # the first load holds files with and without the column
    S.write_files(c.where("c_acctbal < 0").select("c_custkey", "c_name"), f"{src}/first")
    S.write_files(c.where("c_acctbal between 0 and 5000").select("c_custkey", "c_name", "c_mktsegment"), f"{src}/wider")
    copy_into(table, src, "parquet", merge_schema=True, glob="*.parquet")
    S.write_files(c.where("c_acctbal > 5000").select("c_custkey", "c_name", "c_mktsegment"), f"{src}/second")
    copy_into(table, src, "parquet", merge_schema=True, glob="*.parquet")
    return table.read()


@query("s10_copy_into_csv_headers", """
select s_suppkey::varchar || case when s_suppkey % 3 = 1 then '-x' else '' end as id, s_name as name, case when s_suppkey % 3 > 0 then s_acctbal end as balance, case when s_suppkey % 3 = 2 then s_nationkey end::integer as nation from supplier
""")
def s10_csv(spark, d):
    """CSV files of three headers in one load: columns in other places, a column more, an id that is a number in some files only."""
    src, table = workdir(spark, "s10csv"), VersionedTable(spark, workdir(spark, "s10t"))
    s = load(spark, d, "supplier")
    shapes = {0: ["s_suppkey id", "s_name name"], 1: ["s_acctbal balance", "concat(s_suppkey, '-x') id", "s_name name"], 2: ["s_name name", "s_nationkey nation", "s_suppkey id", "s_acctbal balance"]}
    for rest, columns in shapes.items():
        S.write_files(s.where(F.col("s_suppkey") % 3 == rest).selectExpr(*[c.rsplit(" ", 1)[0] + " as " + c.rsplit(" ", 1)[1] for c in columns]), f"{src}/{rest}", "csv", options={"header": "true"})
    copy_into(table, src, "csv", options={"header": "true", "inferSchema": "true"}, merge_schema=True, glob="*.csv")
    return table.read().select("id", "name", "balance", "nation")


@query("s11_stream_new_files", "select event_id, event_type from events")
def s11(spark, d):
    base = workdir(spark, "s11")
    ev = load(spark, d, "events").select("event_id", "event_type")
    sink, ck = f"{base}/sink", f"{base}/checkpoint"
    stream = lambda: SF.stream_files(spark, f"{base}/in/*", "json", schema_dir=f"{base}/schema")
    S.write_files(ev.where("event_type = 'view'"), f"{base}/in/first", "json")
    SF.run_available_now(stream(), sink, ck)
    S.write_files(ev.where("event_type <> 'view'"), f"{base}/in/second", "json")
    SF.run_available_now(stream(), sink, ck)
    return spark.read.parquet(sink)


@query("s12_rescued_data", """
select case when o_orderkey % 11 <> 3 and o_orderkey % 17 <> 5 then o_orderkey end as id, case when o_orderkey % 11 <> 3 then o_orderstatus end as state,
  case when o_orderkey % 11 = 3 then '{"_malformed":"lost ' || o_orderkey || '"}'
    when o_orderkey % 17 = 5 and o_orderstatus = 'P' then '{"id":"no ' || o_orderkey || '","extra":"' || o_orderpriority || '"}'
    when o_orderkey % 17 = 5 then '{"id":"no ' || o_orderkey || '"}'
    when o_orderstatus = 'P' then '{"extra":"' || o_orderpriority || '"}' end as _rescued_data
from orders
""")
def s12(spark, d):
    path = workdir(spark, "s12")
    extra = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("extra")
    key = F.col("o_orderkey")
    typed = F.to_json(F.struct(key.alias("id"), F.col("o_orderstatus").alias("state"), extra))
    wrong = F.to_json(F.struct(F.concat(F.lit("no "), key.cast("string")).alias("id"), F.col("o_orderstatus").alias("state"), extra))
    doc = F.when(key % 11 == 3, F.concat(F.lit("lost "), key.cast("string"))).when(key % 17 == 5, wrong).otherwise(typed)
    S.write_files(load(spark, d, "orders").select(doc.alias("value")), path, "text")
    return S.with_rescued(spark.read.text(path), "id long, state string")


@query("s12_rescued_nested", """
select event_id as id, case when event_id % 5 <> 0 then user_id end as who,
  case when event_id % 5 = 0 and event_id % 3 = 0 then '{"at.more":"' || event_type || '","who.id":"u' || user_id || '"}'
    when event_id % 5 = 0 then '{"who.id":"u' || user_id || '"}' when event_id % 3 = 0 then '{"at.more":"' || event_type || '"}' end as _rescued_data,
  case when event_id % 7 <> 0 then event_type end as second from events where event_id % 7 <> 0
union all
select event_id, case when event_id % 5 <> 0 then user_id end,
  '{' || case when event_id % 3 = 0 then '"at.more":"' || event_type || '",' else '' end || case when event_id % 5 = 0 then '"who.id":"u' || user_id || '",' else '' end || '"tags[1].n":"7"}', null from events where event_id % 7 = 0
""")
def s12_nested(spark, d):
    """A wrong value inside a struct, a new field inside another, a wrong element inside an array."""
    path, n = workdir(spark, "s12n"), F.col("event_id")
    who = F.when(n % 5 == 0, F.format_string('"u%d"', "user_id")).otherwise(F.col("user_id").cast("string"))
    more = F.when(n % 3 == 0, F.format_string(', "more": "%s"', "event_type")).otherwise(F.lit(""))
    tag = F.when(n % 7 == 0, F.lit('{"n": 7, "t": null}')).otherwise(F.format_string('{"t": "%s"}', "event_type"))
    doc = F.format_string('{"id": %d, "at": {"day": 1%s}, "who": {"id": %s}, "tags": [{"t": "a"}, %s]}', n, more, who, tag)
    S.write_files(load(spark, d, "events").select(doc.alias("value")), path, "text")
    got = S.with_rescued(spark.read.text(path), "id long, at struct<day: int>, who struct<id: long>, tags array<struct<t: string>>")
    return got.select("id", F.col("who.id").alias("who"), "_rescued_data", F.col("tags")[1]["t"].alias("second"))


@query("s13_provenance", "select s_suppkey, 'supplier.parquet' as file, true as stamped from supplier")
def s13(spark, d):
    df = S.with_provenance(load(spark, d, "supplier"))
    return df.select("s_suppkey", F.regexp_extract("source_file", "[^/]+$", 0).alias("file"), F.col("processed_at").isNotNull().alias("stamped"))


@query("s14_run_once_to_table", ORDER_SQL)
def s14(spark, d):
    base, name = workdir(spark, "s14"), _table("s14")
    S.write_files(load(spark, d, "orders").select(*ORDER_COLS), f"{base}/in")
    for _ in range(2):  # the second run finds nothing new
        sdf = SF.stream_files(spark, f"{base}/in", "parquet", "o_orderkey long, o_custkey long, o_orderstatus string")
        SF.run_available_now(sdf, f"{base}/table", f"{base}/checkpoint", table=name)
    return spark.table(name)


@query("s15_write_files_overwrite", ORDER_SQL)
def s15(spark, d):
    path = workdir(spark, "s15")
    o = load(spark, d, "orders").select(*ORDER_COLS)
    S.write_files(o.where("o_orderstatus = 'F'"), path, "json")
    S.write_files(o, path, "json")
    return S.read_json(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string")


@query("s16_save_as_table", ORDER_SQL)
def s16(spark, d):
    name, path = _table("s16"), workdir(spark, "s16")
    o = load(spark, d, "orders").select(*ORDER_COLS)
    S.save_table(o.where("o_orderstatus = 'F'"), name, path=path)
    S.save_table(o, name, "overwrite", path=path)
    return spark.table(name)


@query("s17_ctas_modes", "select c_mktsegment, count(*) as n from customer group by c_mktsegment")
def s17(spark, d):
    name = _table("s17")
    c = load(spark, d, "customer")
    S.ctas(spark, name, c.select("c_mktsegment"), path=workdir(spark, "s17a"))
    S.ctas(spark, name, c.select("c_name"), "ignore", path=workdir(spark, "s17b"))
    return S.ctas(spark, name, c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), "replace", path=workdir(spark, "s17c"))


@query("s18_ctas_partitioned_sorted", "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'")
def s18(spark, d):
    t = S.ctas(spark, _table("s18"), load(spark, d, "orders"), partition_by=["o_orderstatus"], sort_by=["o_orderdate"], path=workdir(spark, "s18"))
    return t.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


@query("s19_file_count", "select cast(4 as bigint) as n_files, count(*) as n_rows from orders")
def s19(spark, d):
    path = workdir(spark, "s19")
    S.write_files(load(spark, d, "orders"), path, files=4)
    n = list_files(spark, path, "*.parquet").count()
    return spark.read.parquet(path).agg(F.lit(n).cast("long").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))


@query("s20_literal_rows", """
select s.label, count(*) as n from orders o
join (values ('F', 'finished'), ('O', 'open'), ('P', 'pending')) s(code, label) on o.o_orderstatus = s.code group by s.label
""")
def s20(spark, d):
    codes = S.rows(spark, [("F", "finished"), ("O", "open"), ("P", "pending")], "code string, label string")
    o = load(spark, d, "orders").groupBy("o_orderstatus").count()
    return o.join(codes, o.o_orderstatus == codes.code).select("label", F.col("count").alias("n"))


@query("s21_row_generator", """
select r.id, count(o.o_orderkey) as n from (select unnest(range(0, (select max(c_custkey) + 1 from customer))) as id) r
left join orders o on o.o_custkey = r.id group by r.id
""")
def s21(spark, d):
    c, o = load(spark, d, "customer", "orders")
    ids = spark.range(c.agg(F.max("c_custkey")).first()[0] + 1)
    n = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return ids.join(n, ids.id == n.o_custkey, "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


@query("s22_export_slices", "select o_orderkey, o_orderstatus as location, strftime(o_orderdate, '%Y-%m') as ts_date from orders")
def s22(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("location"), F.date_format("o_orderdate", "yyyy-MM").alias("ts_date"))
    path = S.export_all(o, workdir(spark, "s22"))
    schema = "o_orderkey long, exported_ts long, location string, ts_date string"
    return spark.read.schema(schema).json(path).select("o_orderkey", "location", "ts_date")


@query("s23_export_corrections", """
select o_orderkey, 'CANCELED' as state, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as ts from orders where o_orderstatus = 'P'
""")
def s23(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("ts"))
    return S.correction_rows(o, "state", "ts", pending="P")


@query("s24_stable_sample", "select o_orderkey, o_custkey from orders where substr(md5('42|' || o_orderkey::varchar), 1, 8) <= '0ccccccc'")
def s24(spark, d):
    return S.stable_sample(load(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 0.05)


@query("s25_generated_orders", """
select s_name as store_id, strftime(dd, '%Y-%m-%d') as day, cast(84 as bigint) as slots, true as volume_ok, true as values_ok
from supplier, (select unnest(generate_series(timestamp '2024-01-05', timestamp '2024-01-07', interval 1 day)) as dd)
""")
def s25(spark, d):
    s, p = load(spark, d, "supplier", "part")
    products = sorted(r[0] for r in p.select("p_brand").distinct().collect())
    o = G.gen_orders(s.select(F.col("s_name").alias("store_id"), F.lit("AU").alias("country")), "2024-01-05", "2024-01-07", products)
    n_items = F.size("sale_items")
    ok = (
        F.col("state").isin("COMPLETED", "PENDING", "CANCELED") & F.col("customer_id").between(0, G.MAX_MEMBER) & n_items.between(1, 5)
        & F.forall("sale_items", lambda i: i["cost"].isin(5, 7, 9) & ((i["id"] == "custom") == i["ingredients"].isNotNull()))
    )
    per_slot = o.groupBy("store_id", "ts").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.bool_and(ok).alias("ok"))
    return per_slot.groupBy("store_id", F.substring("ts", 1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("slots"),
        F.bool_and(F.col("n").between(1, 20) & (F.col("n") == F.col("ids"))).alias("volume_ok"),
        F.bool_and("ok").alias("values_ok"),
    )
