"""Scalar, JSON and user-defined functions."""

from __future__ import annotations

from ..functions import nested as N, scalar as X, udfs as D
from ..sources.generate import pick, uniform
from .registry import F, day_text, load, query


@query("f01_length", "select c_custkey, cast(length(c_name) as integer) as n, length(c_mktsegment) = 8 as ok from customer")
def f01(spark, d):
    return load(spark, d, "customer").select("c_custkey", F.length("c_name").alias("n"), (F.length("c_mktsegment") == 8).alias("ok"))


@query("f02_composite_id", "select o_orderkey, nullif(o_orderstatus, 'P') || '-' || cast(o_custkey as varchar) as unique_customer_id from orders")
def f02(spark, d):
    return load(spark, d, "orders").select("o_orderkey", X.composite_id(F.expr("nullif(o_orderstatus, 'P')"), F.col("o_custkey")).alias("unique_customer_id"))


@query("f03_concat", "select p_partkey, p_name || ' + ' || p_brand || ' + ' || p_type as full_menu from part")
def f03(spark, d):
    return load(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(" + "), "p_brand", F.lit(" + "), "p_type").alias("full_menu"))


@query("f04_concat_ws", """
select o_orderkey, concat_ws('|', o_orderstatus, nullif(o_orderpriority, '5-LOW'), cast(o_custkey as varchar)) as pk,
  nullif(o_orderpriority, '5-LOW') || o_orderstatus || nullif(o_orderpriority, '5-LOW') || '' as odd from orders
""")
def f04(spark, d):
    o = load(spark, d, "orders").withColumn("p", F.expr("nullif(o_orderpriority, '5-LOW')"))
    odd = F.expr("p || concat_ws(p, o_orderstatus, '')")  # the separator may be a column, and a NULL one gives NULL
    return o.select("o_orderkey", F.concat_ws("|", "o_orderstatus", "p", F.col("o_custkey").cast("string")).alias("pk"), odd.alias("odd"))


@query("f05_hex_byte", "select l_orderkey, l_linenumber, printf('%02X', cast(least(greatest(0, l_quantity * 10 - 50), 255) as integer)) as h from lineitem")
def f05(spark, d):
    x = (F.col("l_quantity") * 10 - 50).cast("int")
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.hex_byte(x).alias("h"))


@query("f06_sha1", "select c_custkey, sha1(c_name) as h from customer")
def f06(spark, d):
    return load(spark, d, "customer").select("c_custkey", F.sha1("c_name").alias("h"))


@query("f07_from_unixtime", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as full_text from orders")
def f07(spark, d):
    o = load(spark, d, "orders").withColumn("u", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
    return o.select("o_orderkey", F.from_unixtime("u", "yyyy-MM-dd").alias("day"), F.from_unixtime("u").alias("full_text"))


@query("f08_export_stamp", "select o_orderkey, true as stamped from orders")
def f08(spark, d):
    return load(spark, d, "orders").select("o_orderkey", (F.unix_timestamp() > 1_600_000_000).alias("stamped"))


@query("f09_current_timestamp", "select o_orderkey, true as later from orders")
def f09(spark, d):
    return load(spark, d, "orders").select("o_orderkey", (F.current_timestamp() > F.col("o_orderdate").cast("timestamp")).alias("later"))


@query("f10_date_add", "select event_id, strftime(ts::date - 7, '%Y-%m-%d') as week_before from events")
def f10(spark, d):
    return load(spark, d, "events").select("event_id", day_text(F.date_add("ts", -7)).alias("week_before"))


@query("f11_date_trunc", "select event_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as day from events")
def f11(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    return load(spark, d, "events").select("event_id", F.date_format(F.date_trunc("day", text.cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("day"))


@query("f12_sum_of_text", "select l_returnflag, sum(l_quantity::decimal(18,2))::double as total from lineitem group by l_returnflag")
def f12(spark, d):
    text = load(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("string").alias("cost"))
    return text.groupBy("l_returnflag").agg(F.sum(F.col("cost").cast("decimal(18,2)")).cast("double").alias("total"))


@query("f13_seeded_uniform", "select p_partkey, true as in_range, true as repeatable from part")
def f13(spark, d):
    price = F.round(uniform(42, "price", "p_partkey") * 10, 2)
    p = load(spark, d, "part")
    again = p.repartition(7).select(F.col("p_partkey").alias("k"), price.alias("again"))
    j = p.select("p_partkey", price.alias("price")).join(again, F.col("p_partkey") == F.col("k"))
    return j.select("p_partkey", F.col("price").between(0, 10).alias("in_range"), (F.col("price") == F.col("again")).alias("repeatable"))


@query("f14_unique_ids", "select count(*) as n, count(*) as monotonic, count(*) as uuids, count(*) as hashed from lineitem")
def f14(spark, d):
    li = load(spark, d, "lineitem").select(F.monotonically_increasing_id().alias("m"), F.uuid().alias("u"))
    # counted one at a time: each distinct count is its own two-step aggregate over one narrow column
    one = lambda c: li.select(c).distinct().count()
    n_hashed = load(spark, d, "orders").select(F.sha1(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus"))).distinct().count()
    n_orders = load(spark, d, "orders").count()
    return li.agg(F.count(F.lit(1)).alias("n"), F.lit(one("m")).cast("long").alias("monotonic"), F.lit(one("u")).cast("long").alias("uuids"),
                  (F.count(F.lit(1)) - F.lit(n_orders - n_hashed)).cast("long").alias("hashed"))


@query("f15_power", "select p_partkey, round(1e6 / pow(10, p_size / 10.0), 4) as h from part")
def f15(spark, d):
    return load(spark, d, "part").select("p_partkey", F.round(X.h_concentration(F.col("p_size") / 10.0) * 1e6, 4).alias("h"))


@query("f16_log_ratio", "select l_orderkey, l_linenumber, l_partkey, case when l_discount > 0 and l_tax > 0 then round(ln(l_discount / l_tax), 6) + 0.0 end as acidity_ratio from lineitem")
def f16(spark, d):
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.round(X.log_ratio(F.col("l_discount"), F.col("l_tax")), 6) + 0.0).alias("acidity_ratio"))


def _items(spark, d):
    doc = F.to_json(F.array(F.struct(
        F.col("l_quantity").cast("int").alias("cost"), F.col("l_returnflag").alias("id"),
        F.when(F.col("l_linestatus") == "F", F.array("l_returnflag", "l_linestatus")).alias("ingredients"))))
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", doc.alias("sale_items"))


@query("f17_from_json_items", """
select l_orderkey, l_linenumber, l_partkey, cast(cast(l_quantity as integer) as varchar) as cost, l_returnflag as id,
  case when l_linestatus = 'F' then '["' || l_returnflag || '","F"]' end as ingredients from lineitem
""")
def f17(spark, d):
    x = N.parse_items(_items(spark, d), "sale_items", "cost: STRING, id: STRING, ingredients: STRING", ["l_orderkey", "l_linenumber", "l_partkey"])
    return x.drop("pos")


@query("f18_schema_by_example", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def f18(spark, d):
    return load(spark, d, "events").select("event_id", N.parse_by_example("props", "{'k': 1}").alias("j")).select("event_id", "j.k")


def _doc():
    """A document per part: numbers in nested arrays whose length depends on the size, marks that only some elements have, odd names."""
    n = F.col("p_size") % 4
    cells = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct((i * 10 + n).alias("at"), F.when((i + F.col("p_partkey")) % 2 == 0, F.concat(F.lit("m"), i.cast("string"))).alias("mark")))
    deep = F.struct(F.array(F.array(F.col("p_partkey")), F.array(F.col("p_size"), F.col("p_size") + 1)).alias("pair of"), F.col("p_type").alias("k:ind"))
    return F.to_json(F.struct(F.col("p_name").alias("lot"), F.struct(deep.alias("in")).alias("box"), cells.alias("cells"))).alias("raw")


@query("f19_json_paths", """
select p_partkey, p_name as lot, '[' || p_size || ',' || (p_size + 1) || ']' as pair, (p_size + 1)::varchar as second, p_type as kind, ((p_size % 4) * 10 + p_size % 4)::varchar as last_at,
  cast(null as varchar) as absent from part
""")
def f19(spark, d):
    r = load(spark, d, "part").select("p_partkey", "p_size", _doc())
    p = lambda path: N.json_path("raw", path)
    at = F.coalesce(*[F.when(F.col("p_size") % 4 == i, p(f"$.cells[{i}].at")) for i in range(4)])
    return r.select("p_partkey", p("$.lot").alias("lot"), p("$.box.in['pair of'][1]").alias("pair"), p("$.box.in['pair of'][1][1]").alias("second"), p("$.box['in']['k:ind']").alias("kind"), at.alias("last_at"), p("$.box.out").alias("absent"))


@query("f20_json_wildcard", """
with c as (select p_partkey, list_transform(range(0, p_size % 4 + 1), lambda i: case when (i + p_partkey) % 2 = 0 then 'm' || i end) as m from part)
select p_partkey, len(m)::integer as n_kept, len(list_filter(m, lambda x: x is not null))::integer as n_dropped, m[1] as first_kept, list_filter(m, lambda x: x is not null)[1] as first_dropped, m[2] as second_kept from c
""")
def f20(spark, d):
    r = load(spark, d, "part").select("p_partkey", _doc())
    r = r.select("p_partkey", N.json_paths("raw", "$.cells", "mark").alias("kept"), N.json_paths("raw", "$.cells", "mark", keep_missing=False).alias("dropped"))
    return r.select("p_partkey", F.size("kept").alias("n_kept"), F.size("dropped").alias("n_dropped"), F.get("kept", F.lit(0)).alias("first_kept"), F.get("dropped", F.lit(0)).alias("first_dropped"), F.get("kept", F.lit(1)).alias("second_kept"))


@query("f21_nested_event_path", "select event_id, cast(event_id as varchar) as num_output_rows, event_type as first_name from events")
def f21(spark, d):
    details = F.to_json(F.struct(F.struct(
        F.struct(F.col("event_id").alias("num_output_rows")).alias("metrics"),
        F.struct(F.array(F.struct(F.col("event_type").alias("name"))).alias("expectations")).alias("data_quality")).alias("flow_progress")))
    e = load(spark, d, "events").select("event_id", details.alias("details"))
    return e.select("event_id", N.json_path("details", "$.flow_progress.metrics.num_output_rows").alias("num_output_rows"),
                    N.json_path("details", "$.flow_progress.data_quality.expectations[0].name").alias("first_name"))


@query("f22_arrays_zip_rows", """
select o_orderkey, u.time, u.temp, u.rain from orders,
 lateral (values ('a', o_custkey, o_orderstatus), ('b', o_orderkey, null), ('c', null, null)) u(time, temp, rain)
""")
def f22(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.struct(
        F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("time"), F.array("o_custkey", "o_orderkey").alias("temp"), F.array("o_orderstatus").alias("rain")).alias("h"))
    return N.zip_rows(o, {"time": "h.time", "temp": "h.temp", "rain": "h.rain"}, ["o_orderkey"])


@query("f23_posexplode", """
select p_partkey, cast(unnest(range(len(w))) as integer) as pos, unnest(w) as word from (select p_partkey, string_split(p_name, ' ') as w from part)
""")
def f23(spark, d):
    return load(spark, d, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word"))


@query("f24_calendar", """
select o_custkey, strftime(dd, '%Y-%m-%d') as day from (
 select o_custkey, unnest(generate_series(min(o_orderdate), min(o_orderdate) + interval 6 day, interval 1 day)) as dd from orders group by o_custkey)
""")
def f24(spark, d):
    o = load(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"))
    return X.calendar(o.withColumn("b", F.date_add("a", 6)), "a", "b").select("o_custkey", day_text("day").alias("day"))


BUSY_SQL = """((dayofweek(ts) in (0, 6) or month(ts) in (12, 1, 2)) and (hour(ts) between 10 and 14 or hour(ts) between 16 and 19))
  or hour(ts) between 11 and 12 or hour(ts) between 16 and 17"""


@query("f25_busy_time", f"select event_id, {BUSY_SQL.replace('ts', 'shifted')} as busy from (select event_id, ts + interval 5 month as shifted from events)")
def f25(spark, d):
    # five months later, so that weekdays outside the busy season occur
    e = load(spark, d, "events").select("event_id", F.expr("ts + interval 5 months").alias("t"))
    return e.select("event_id", X.busy_time(F.to_date("t"), F.hour("t")).alias("busy"))


@query("f26_bank_holiday", """
select o_orderkey, h.day is not null as is_holiday from orders left join
 (select distinct strftime(ts, '%m-%d') as day from events where event_type = 'error') h on strftime(o_orderdate, '%m-%d') = h.day and o_orderstatus = 'F'
""")
def f26(spark, d):
    o, e = load(spark, d, "orders", "events")
    # the holiday table is an input: here the calendar days with an error event, for every year with orders
    md = lambda c: F.date_format(c, "MM-dd")
    days = o.select(F.to_date("o_orderdate").alias("date")).distinct()
    err = e.where("event_type = 'error'").select(md("ts").alias("m")).distinct()
    hol = days.join(err, md(days["date"]) == err["m"], "left_semi").select(F.lit("F").alias("country"), "date")
    return X.with_holiday(o, hol, "o_orderdate", "o_orderstatus").select("o_orderkey", "is_holiday")


@query("f27_map_with_default", "select c_custkey, case when n_name in ('NATION_4', 'NATION_5') then 'NZ' else 'AU' end as country from customer join nation on c_nationkey = n_nationkey")
def f27(spark, d):
    c, n = load(spark, d, "customer", "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select("c_custkey", X.lookup(F.col("n_name"), {"NATION_4": "NZ", "NATION_5": "NZ"}, "AU").alias("country"))


@query("f28_backfill_start", """
select o_orderkey, strftime(case when day(b) = 1 then date_trunc('month', b) - interval 1 month else date_trunc('month', b) end, '%Y-%m-%d') as start
from (select o_orderkey, o_orderdate - interval 3 month as b from orders)
""")
def f28(spark, d):
    return load(spark, d, "orders").select("o_orderkey", day_text(X.backfill_start(F.to_date("o_orderdate"), 3)).alias("start"))


@query("f29_current_user", "select count(*) as n, true as known from customer")
def f29(spark, d):
    return load(spark, d, "customer").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.length(F.current_user()) > 0).alias("known"))


# --- functions defined by the user ------------------------------------------------------------------


@query("d01_sql_function_literal", "select p_partkey, '0000FF' as color from part")
def d01(spark, d):
    D.literal_function(spark, "lk_blue", "0000FF")
    load(spark, d, "part").createOrReplaceTempView("lk_part")
    return spark.sql("select p_partkey, lk_blue() as color from lk_part")


@query("d02_sql_function_expression", "select p_partkey, p_brand || ' no. ' || cast(p_size % 7 as varchar) as h from part")
def d02(spark, d):
    D.sql_function(spark, "lk_mark", "brand STRING, size INT", "brand || ' no. ' || cast(size % 7 as string)")
    load(spark, d, "part").createOrReplaceTempView("lk_part")
    return spark.sql("select p_partkey, lk_mark(p_brand, p_size) as h from lk_part")


@query("d03_sql_function_lookup", "select l_orderkey, l_linenumber, l_partkey, p_name as name from lineitem left join part on l_partkey = p_partkey")
def d03(spark, d):
    li, p = load(spark, d, "lineitem", "part")
    li.createOrReplaceTempView("lk_lineitem")
    p.createOrReplaceTempView("lk_part")
    D.lookup_function(spark, "lk_part_name", "lk_part", "p_partkey", "p_name", "BIGINT")
    return spark.sql("select l_orderkey, l_linenumber, l_partkey, lk_part_name(l_partkey) as name from lk_lineitem")


@query("d04_values_without_arguments", """
select c_custkey, ['FR', 'USA', 'SPAIN'][1 + cast(floor(cast(('0x' || substr(md5('42|country|' || c_custkey), 1, 8)) as bigint) / 4294967296.0 * 3) as bigint)] as country from customer
""")
def d04(spark, d):
    c = load(spark, d, "customer")
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("42"), F.lit("country"), F.col("c_custkey").cast("string"))), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return c.select("c_custkey", pick(["FR", "USA", "SPAIN"], u).alias("country"))


MODEL_SQL = "select l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(-(0.05 * l_quantity - 2 * l_discount - 0.5))), 6) as prediction from lineitem"


def _scored(spark, d):
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")


@query("d05_model_function", MODEL_SQL)
def d05(spark, d):
    f = D.model_function(D.linear_predictor([0.05, -2.0], -0.5), ["l_quantity", "l_discount"])
    return _scored(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", F.round(f("l_quantity", "l_discount"), 6).alias("prediction"))


@query("d06_model_function_in_sql", "select l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(-(0.05 * l_quantity - 2 * l_discount - 0.5))), 6) as prediction from lineitem")
def d06(spark, d):
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount"]
    D.register_model(spark, "lk_quality_prediction", D.linear_predictor([0.0, 0.0, 0.0, 0.05, -2.0], -0.5), names)
    _scored(spark, d).createOrReplaceTempView("lk_features")
    s = spark.sql("select *, lk_quality_prediction(*) as p from lk_features")
    return s.select("l_orderkey", "l_linenumber", "l_partkey", F.round("p", 6).alias("prediction"))
