"""The business questions over the star schema: orders play the sales, lineitem the sale items, customers
joined to nations the stores, events the weather and the product changes."""

from __future__ import annotations

from ..operators import pairs as PA, quality as Q, scd
from ..sources.files import create_view
from . import gold
from .q_changes import SCD2_OUT, SCD2_SQL, change_log, history, _out
from .registry import F, load, query

STATE_SQL = "case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'PENDING' else 'CANCELED' end"
SALES_SQL = f"""(select o_orderkey as id, o_orderdate as ts, n_name as store_id, o_custkey as customer_id, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'ONLINE' else 'IN-STORE' end as order_source,
  {STATE_SQL} as order_state from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


def sales(spark, d):
    o, c, n = load(spark, d, "orders", "customer", "nation")
    cust = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("store_id"))
    state = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "PENDING").otherwise("CANCELED")
    source = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "ONLINE").otherwise("IN-STORE")
    return o.join(cust, o.o_custkey == cust.c_custkey).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"), "store_id", F.col("o_custkey").alias("customer_id"), source.alias("order_source"), state.alias("state"))


def stores(spark, d):
    n, r = load(spark, d, "nation", "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("id"), F.concat(F.lit("Store "), "n_name").alias("name"), F.col("r_name").alias("city"), F.substring("r_name", 1, 3).alias("country_code"))


STORES_SQL = "(select n_name as id, 'Store ' || n_name as name, r_name as city, substr(r_name, 1, 3) as country_code from nation join region on n_regionkey = r_regionkey)"

LI_ORDER = ", ".join(f"{c} desc" for c in ["l_shipdate", "l_extendedprice", "l_orderkey", "l_partkey", "l_suppkey"])


@query("b01_sales_by_country", """
with s as (select l_orderkey, l_linenumber, l_suppkey from
  (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_extendedprice desc, l_partkey desc, l_suppkey desc) as rn from lineitem) where rn = 1)
select n_name as country_code, count(distinct l_orderkey) as number_of_sales from s join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1
""")
def b01(spark, d):
    li, s, n = load(spark, d, "lineitem", "supplier", "nation")
    log = li.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey")
    current = scd.apply_changes(log, ["l_orderkey", "l_linenumber"], "l_shipdate", tie_by=["l_extendedprice", "l_partkey", "l_suppkey"])
    st = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("country_code"))
    return gold.country_sales(current.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("store_id")), st)


@query("b02_daily_sales_and_weather", """
with weather as (select day(ts) as day, sum(value::decimal(18,4))::double / count(*) as average_temperature from events where event_type <> 'view' group by 1),
 sale as (select l_shipdate, l_orderkey, sum(l_extendedprice::decimal(18,2)) as total from lineitem group by 1, 2),
 s as (select day(l_shipdate) as day, sum(total)::double / count(*) as average_daily_cost, sum(total)::double as total_daily_cost from sale group by 1)
select cast(s.day as integer) as day, round(average_daily_cost, 6) as average_daily_cost, total_daily_cost, round(average_temperature, 6) as average_temperature from s left join weather on s.day = weather.day
""")
def b02(spark, d):
    li, e = load(spark, d, "lineitem", "events")
    items = li.select(F.col("l_shipdate").alias("sale_ts"), F.col("l_orderkey").alias("sale_id"), F.col("l_extendedprice").alias("product_cost"))
    weather = e.select(F.col("ts").alias("time"), F.when(F.col("event_type") != "view", F.col("value")).alias("temperature_2m"))
    g = gold.daily_sales_and_weather(items, weather, F.dayofmonth)  # the two tables share days of the month only
    return g.select("day", F.round("average_daily_cost", 6).alias("average_daily_cost"), "total_daily_cost", F.round("average_temperature", 6).alias("average_temperature"))


@query("b03_store_last_days", f"select id, customer_id from {SALES_SQL} where store_id = 'NATION_3' and ts >= timestamp '2001-07-18' ")
def b03(spark, d):
    return gold.store_last_days(sales(spark, d), "NATION_3", "2001-07-25").select("id", "customer_id")


CITY_SQL = f"""(select a.store_id, a.order_source, a.order_state, b.city, b.country_code, b.name as store_name, count(*) as cnt
 from {SALES_SQL} a join {STORES_SQL} b on a.store_id = b.id group by all)"""


def _by_city(spark, d):
    return gold.orders_by_city(sales(spark, d).withColumnRenamed("state", "order_state"), stores(spark, d))


@query("b04_orders_by_city", f"select * from {CITY_SQL}")
def b04(spark, d):
    create_view(_by_city(spark, d), "lk_order_by_city")
    return spark.table("lk_order_by_city")


@query("b05_cancelled_per_store", f"select store_name, cnt as canceled_per_store from {CITY_SQL} where order_state = 'CANCELED'")
def b05(spark, d):
    return gold.cancelled_per_store(_by_city(spark, d))


@query("b06_clean_sales", f"""
select id, store_id || '-' || cast(customer_id as varchar) as unique_customer_id, order_source, order_state, length(store_id) = 5 as location_ok, order_state in ('CANCELED', 'COMPLETED') as state_ok from {SALES_SQL}
""")
def b06(spark, d):
    s = gold.sales_clean(sales(spark, d).withColumn("sale_items", F.lit(None).cast("string")))
    location, state = gold.SALES_RULES.values()
    return s.select("id", "unique_customer_id", "order_source", "order_state", Q.holds(location).alias("location_ok"), Q.holds(state).alias("state_ok"))


@query("b07_sale_items", """
select l_orderkey || '-' || l_linenumber || '-' || pos as id, l_orderkey as sale_id, pos as item_number, item as product_id, cast(cast(l_quantity as integer) as varchar) as product_cost,
  case when pos = 0 then '["' || l_linestatus || '"]' end as product_ingredients, pos = 0 or item <> 'A' as ok
from (select l_orderkey, l_linenumber, l_quantity, l_linestatus, cast(0 as integer) as pos, l_returnflag as item from lineitem
 union all select l_orderkey, l_linenumber, l_quantity, l_linestatus, 1, l_returnflag from lineitem)
""")
def b07(spark, d):
    li = load(spark, d, "lineitem")
    item = lambda ing: F.struct(F.col("l_quantity").cast("int").alias("cost"), F.col("l_returnflag").alias("id"), ing.alias("ingredients"), F.lit("").alias("notes"), F.lit("Small").alias("size"))
    doc = F.to_json(F.array(item(F.array("l_linestatus")), item(F.lit(None).cast("array<string>"))))
    raw = li.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), F.col("l_shipdate").alias("ts"), F.lit("S").alias("store_id"), doc.alias("sale_items"))
    x = gold.sale_items(raw)
    rule = next(iter(gold.item_rules("A").values()))
    return x.select("id", F.split("sale_id", "-")[0].cast("long").alias("sale_id"), "item_number", "product_id", "product_cost", "product_ingredients", Q.holds(rule).alias("ok"))


@query("b08_weather_hours", """
select concat_ws('|', user_id, event_id, m.time) as pk, user_id as place, m.time, case when m.time = 'T00' then value end as temperature_2m, case when m.time = 'T00' then cast(json_extract_string(props, '$.k') as double) else value end as rain
from events, (values ('T00'), ('T01')) m(time)
""")
def b08(spark, d):
    e = load(spark, d, "events")
    hourly = F.to_json(F.struct(
        F.array(F.get_json_object("props", "$.k").cast("double"), F.col("value")).alias("rain"), F.array("value").alias("temperature_2m"), F.array(F.lit("T00"), F.lit("T01")).alias("time")))
    raw = e.select(F.col("user_id").alias("latitude"), F.col("event_id").alias("longitude"), F.lit("UTC").alias("timezone"), F.col("event_id").cast("double").alias("generationtime_ms"), hourly.alias("hourly"))
    w = scd.apply_changes(gold.weather_hours(raw.unionByName(raw)), "pk", "generationtime_ms", ignore_null_updates=True)
    return w.select("pk", F.col("latitude").alias("place"), "time", "temperature_2m", "rain")


@query("b09_stores_per_country", """
select case when n_name in ('NATION_1', 'NATION_2', 'NATION_3') then 'AUS' when n_name in ('NATION_4', 'NATION_5') then 'NZL' end as store_country, count(*) as number_of_stores
from supplier join nation on s_nationkey = n_nationkey group by 1
""")
def b09(spark, d):
    s, n = load(spark, d, "supplier", "nation")
    st = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_name").alias("id"))
    return gold.stores_per_country(st, {"AUS": ["NATION_1", "NATION_2", "NATION_3"], "NZL": ["NATION_4", "NATION_5"]})


@query("b10_product_history", SCD2_SQL + f"select user_id, kind, value, {SCD2_OUT} from f where not is_del and kind is not null")
def b10(spark, d):
    return _out(history(spark, d, log=change_log(spark, d)), "kind", "value").where("kind is not null")


@query("b11_dinner_price", "select p_partkey as recipe_id, p_name || ' + ' || p_brand || ' + ' || p_type as full_menu, p_retailprice as price from part")
def b11(spark, d):
    p = load(spark, d, "part")
    menu = p.select(F.col("p_partkey").alias("recipe_id"), F.col("p_name").alias("app"), F.col("p_brand").alias("main"), F.col("p_type").alias("desert"))
    return gold.dinner_price(gold.dinner(menu), p.select(F.col("p_partkey").alias("recipe_id"), F.col("p_retailprice").alias("price")))


@query("b12_popular_combinations", """
with b as (select distinct l_orderkey, p_name as item from lineitem join part on l_partkey = p_partkey),
 c as (select l_orderkey, string_agg(item, ',' order by item) as combo from b group by l_orderkey),
 t as (select combo, count(*) as n_sales, min(l_orderkey) as first_sale from c group by combo order by n_sales desc, first_sale limit 20)
select t.n_sales, t.first_sale, b.item from t join b on b.l_orderkey = t.first_sale
""")
def b12(spark, d):
    li, p = load(spark, d, "lineitem", "part")
    return gold.popular_combinations(li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", F.col("p_name").alias("item")), "l_orderkey", "item")


@query("b12_popular_item_pairs", """
with b as (select distinct l_orderkey as s, l_partkey as i from lineitem)
select a.i as item_a, c.i as item_b, count(*) as n_sales from b a join b c on a.s = c.s and a.i < c.i group by all order by n_sales desc, item_a, item_b limit 20
""")
def b12_pairs(spark, d):
    return PA.top_pairs(load(spark, d, "lineitem"), "l_orderkey", "l_partkey")


@query("b12_popular_supplier_pairs", """
with b as (select distinct o_custkey as s, l_suppkey as i from lineitem join orders on l_orderkey = o_orderkey)
select a.i as item_a, c.i as item_b, count(*) as n_sales from b a join b c on a.s = c.s and a.i < c.i group by all order by n_sales desc, item_a, item_b limit 50
""")
def b12_suppliers(spark, d):
    li, o = load(spark, d, "lineitem", "orders")
    return PA.top_pairs(li.join(o, li.l_orderkey == o.o_orderkey), "o_custkey", "l_suppkey", k=50)
