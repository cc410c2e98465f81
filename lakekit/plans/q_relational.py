"""Projections, filters, joins, aggregates, windows, ordering and unions."""

from __future__ import annotations

from ..functions import scalar as X, udfs as D
from ..operators import governance as GV, ml as M, profile as PR
from ..operators.skew import ordered_scan
from . import gold
from .registry import F, day_text, load, money, query, ts_text, workdir

# --- projections and filters ------------------------------------------------------------------------


@query("p01_select_alias", "select o_orderkey as id, o_custkey as customer_id, o_orderstatus as order_state from orders")
def p01(spark, d):
    return load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("order_state"))


@query("p02_star_except", "select * exclude (c_acctbal, c_mktsegment) from customer")
def p02(spark, d):
    load(spark, d, "customer").createOrReplaceTempView("lk_customer")
    return spark.sql("select * except (c_acctbal, c_mktsegment) from lk_customer")


NATION_GROUPS = {"AUS": ["NATION_1", "NATION_2", "NATION_3"], "NZL": ["NATION_4", "NATION_5"]}
NATION_CASE = "case when n_name in ('NATION_1', 'NATION_2', 'NATION_3') then 'AUS' when n_name in ('NATION_4', 'NATION_5') then 'NZL' end"


@query("p03_case_in_groups", f"select c_custkey, {NATION_CASE} as country_code from customer join nation on c_nationkey = n_nationkey")
def p03(spark, d):
    c, n = load(spark, d, "customer", "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", X.case_in(F.col("n_name"), NATION_GROUPS).alias("country_code"))


@query("p04_literal_columns", "select o_orderkey, 'insert' as _change_type, '2023-01-01 00:00:00.000' as _change_timestamp from orders")
def p04(spark, d):
    return load(spark, d, "orders").select("o_orderkey", F.lit("insert").alias("_change_type"), F.lit("2023-01-01 00:00:00.000").alias("_change_timestamp"))


@query("p05_predicates", """
select o_orderkey, o_orderstatus from orders
where o_orderstatus in ('F', 'O') and not (o_orderpriority = '5-LOW' and o_totalprice < 100000) and nullif(o_custkey, 7) is not null
""")
def p05(spark, d):
    load(spark, d, "orders").createOrReplaceTempView("lk_orders")
    return spark.sql("""
        select o_orderkey, o_orderstatus from lk_orders
        where o_orderstatus in ("F", "O") and not (o_orderpriority == "5-LOW" and o_totalprice < 100000) and nullif(o_custkey, 7) is not null""")


@query("p06_last_days", "select event_id from events where ts >= timestamp '2024-01-23 00:00:00' and event_type = 'purchase'")
def p06(spark, d):
    return load(spark, d, "events").where(X.last_days(F.col("ts"), "2024-01-30", 7) & (F.col("event_type") == "purchase")).select("event_id")


@query("p07_query_parameters", "select o_orderpriority, count(*) as cnt from orders where o_orderstatus = 'F' group by o_orderpriority having count(*) > 5")
def p07(spark, d):
    load(spark, d, "orders").createOrReplaceTempView("lk_orders")
    return spark.sql(
        "select o_orderpriority, count(*) as cnt from lk_orders where o_orderstatus = :state group by o_orderpriority having cnt > :least",
        args={"state": "F", "least": 5},
    )


@query("p08_name_substitution", "select count(*) as n from orders")
def p08(spark, d):
    load(spark, d, "orders").createOrReplaceTempView("lk_orders")
    return spark.sql("select count(*) as n from identifier(:t)", args={"t": "lk_orders"})


@query("p09_struct_and_element", "select p_partkey, p_name as name, string_split(p_name, ' ')[1] as first_word, string_split(p_name, ' ')[2] as second_word from part")
def p09(spark, d):
    s = load(spark, d, "part").select("p_partkey", F.struct(F.col("p_name").alias("name"), F.split("p_name", " ").alias("words")).alias("s"))
    return s.select("p_partkey", F.col("s.name").alias("name"), F.get(F.col("s.words"), 0).alias("first_word"), F.get(F.col("s.words"), 1).alias("second_word"))


@query("p10_cast", "select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as integer) as level, try_cast(o_orderstatus as integer) as bad from orders")
def p10(spark, d):
    return load(spark, d, "orders").select("o_orderkey", F.expr("cast(substr(o_orderpriority, 1, 1) as int)").alias("level"), F.expr("try_cast(o_orderstatus as int)").alias("bad"))


@query("p11_partition_filter", "select o_orderkey, o_orderpriority from orders where o_orderpriority = '2-HIGH' and o_totalprice > 300000")
def p11(spark, d):
    path = workdir(spark, "p11")
    load(spark, d, "orders").hint("rebalance", "o_orderpriority").write.partitionBy("o_orderpriority").parquet(path)
    return spark.read.parquet(path).where("o_orderpriority = '2-HIGH' and o_totalprice > 300000").select("o_orderkey", "o_orderpriority")


@query("p12_binarize", "select c_custkey, case when c_mktsegment = 'BUILDING' then 1 else 0 end as label from customer")
def p12(spark, d):
    return M.binarize(load(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("label")), "label", "BUILDING")


# --- joins ------------------------------------------------------------------------------------------


@query("j01_fact_dimension", """
select o_orderkey, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""")
def j01(spark, d):
    o, c, n = load(spark, d, "orders", "customer", "nation")
    cust = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    return o.join(cust, o.o_custkey == cust.c_custkey).select("o_orderkey", "n_name")


@query("j02_left_join_aggregates", """
with s as (select dayofmonth(o_orderdate) as day, count(*) as orders from orders group by 1),
     e as (select dayofmonth(ts) as day, count(*) as events from events group by 1)
select cast(s.day as integer) as day, s.orders, e.events from s left join e on s.day = e.day
""")
def j02(spark, d):
    o, e = load(spark, d, "orders", "events")
    s = o.groupBy(F.dayofmonth("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    v = e.groupBy(F.dayofmonth("ts").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    return s.join(v, "day", "left").select("day", "orders", "events")


@query("j03_join_using", "select recipe_id, full_menu, price from (select p_partkey as recipe_id, p_name || ' + ' || p_type as full_menu from part) join (select p_partkey as recipe_id, p_retailprice as price from part) using (recipe_id)")
def j03(spark, d):
    p = load(spark, d, "part")
    dinner = p.select(F.col("p_partkey").alias("recipe_id"), F.concat("p_name", F.lit(" + "), "p_type").alias("full_menu"))
    return dinner.join(p.select(F.col("p_partkey").alias("recipe_id"), F.col("p_retailprice").alias("price")), on="recipe_id")


@query("j04_anti_join", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def j04(spark, d):
    o, li = load(spark, d, "orders", "lineitem")
    return o.select("o_orderkey").join(li, o.o_orderkey == li.l_orderkey, "left_anti")


@query("j05_permission_join", """
select c_custkey, p.gdpr_filter from customer join (
  select 'Supplier#000000003' as who, n_name, cast(n_regionkey as integer) as gdpr_filter, n_nationkey from nation
  where n_regionkey in (select n_regionkey from supplier join nation on s_nationkey = n_nationkey where s_name = 'Supplier#000000003')) p
on c_nationkey = p.n_nationkey
""")
def j05(spark, d):
    c, s, n = load(spark, d, "customer", "supplier", "nation")
    home = s.join(n, s.s_nationkey == n.n_nationkey).select("s_name", F.col("n_regionkey").alias("r"))
    perms = home.join(n, home.r == n.n_regionkey).select(F.col("s_name").alias("analyst_email"), F.col("n_nationkey").alias("country_filter"), F.col("n_regionkey").cast("int").alias("gdpr_filter"))
    return GV.permission_filter(c, perms, "c_nationkey", "Supplier#000000003").select("c_custkey", "gdpr_filter")


@query("j06_feature_lookup", """
select o_orderkey, o_orderstatus as label, n_orders, last_day from orders left join
 (select o_custkey, count(*) as n_orders, strftime(max(o_orderdate), '%Y-%m-%d') as last_day from orders group by o_custkey having count(*) > 10) f using (o_custkey)
""")
def j06(spark, d):
    o = load(spark, d, "orders")
    feats = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), day_text(F.max("o_orderdate")).alias("last_day")).where("n_orders > 10")
    M.feature_table(feats, "o_custkey")
    base = o.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("label"))
    return M.training_set(base, feats, "o_custkey", ["n_orders", "last_day"], "label", exclude=["o_custkey"])


@query("j07_scalar_subquery_lookup", "select l_orderkey, l_linenumber, p_name from lineitem left join part on l_partkey = p_partkey")
def j07(spark, d):
    li, p = load(spark, d, "lineitem", "part")
    return D.lookup_join(li.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", p, "p_partkey", "p_name", "p_name").drop("l_partkey")


@query("j08_full_outer", """
with a as (select o_orderkey as k, o_orderstatus as st from orders where o_orderpriority <> '5-LOW'),
     b as (select o_orderkey as k, o_custkey as cu from orders where o_orderstatus <> 'P')
select coalesce(a.k, b.k) as k, st, cu from a full outer join b on a.k = b.k
""")
def j08(spark, d):
    o = load(spark, d, "orders")
    a = o.where("o_orderpriority <> '5-LOW'").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"))
    b = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cu"))
    return a.join(b, "k", "full_outer")


# --- aggregates -------------------------------------------------------------------------------------


@query("a01_count_by_keys", "select n_name, o_orderstatus, o_orderpriority, count(*) as cnt from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all")
def a01(spark, d):
    o, c, n = load(spark, d, "orders", "customer", "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name", "o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("cnt"))


@query("a02_distinct_orders_by_part_brand", "select p_brand, count(distinct l_orderkey) as n from lineitem join part on l_partkey = p_partkey group by p_brand")
def a02(spark, d):
    li, p = load(spark, d, "lineitem", "part")
    return li.join(p, li.l_partkey == p.p_partkey).groupBy("p_brand").agg(F.count_distinct("l_orderkey").alias("n"))


@query("a03_count_column", "select o_orderpriority, count(nullif(o_orderstatus, 'P')) as n from orders group by o_orderpriority")
def a03(spark, d):
    return load(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.expr("nullif(o_orderstatus, 'P')")).alias("n"))


@query("a04_two_level_aggregate", """
select strftime(l_shipdate, '%Y-%m-%d') as day, round(sum(total)::double / count(*), 6) as average_daily_cost, sum(total)::double as total_daily_cost
from (select l_shipdate, l_orderkey, sum(l_extendedprice::decimal(18,2)) as total from lineitem group by 1, 2) group by l_shipdate
""")
def a04(spark, d):
    li = load(spark, d, "lineitem")
    per_sale = li.groupBy("l_shipdate", "l_orderkey").agg(F.sum(money("l_extendedprice")).alias("total"))
    return per_sale.groupBy(day_text("l_shipdate").alias("day")).agg(
        F.round(F.sum("total").cast("double") / F.count(F.lit(1)), 6).alias("average_daily_cost"), F.sum("total").cast("double").alias("total_daily_cost"))


@query("a05_avg_without_nulls", """
select strftime(ts, '%Y-%m-%d') as day, round(sum(v)::double / count(v), 6) as average_value from
 (select ts, nullif(value, 0)::decimal(18,2) as v from events) where v is not null group by 1
""")
def a05(spark, d):
    e = load(spark, d, "events").select("ts", F.expr("cast(nullif(value, 0) as decimal(18,2))").alias("v")).where("v is not null")
    return e.groupBy(day_text(F.date_trunc("day", "ts")).alias("day")).agg(F.round(F.sum("v").cast("double") / F.count("v"), 6).alias("average_value"))


@query("a06_having_alias", "select o_custkey, count(*) as cnt from orders group by o_custkey having count(*) > 15")
def a06(spark, d):
    return load(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 15")


@query("a07_group_by_ordinal", "select c_mktsegment, c_nationkey, count(*) as n from customer group by 1, 2")
def a07(spark, d):
    load(spark, d, "customer").createOrReplaceTempView("lk_customer")
    return spark.sql("select c_mktsegment, c_nationkey, count(*) as n from lk_customer group by 1, 2")


@query("a08_any_value", "select p_brand, min(p_type) as any_type from part group by p_brand")
def a08(spark, d):
    return load(spark, d, "part").groupBy("p_brand").agg(F.min("p_type").alias("any_type"))


@query("a09_global_count", "select count(*) as n from lineitem")
def a09(spark, d):
    return load(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def _profile_sql(c):
    return f"""select '{c}' as "column", count({c}) as count, count(*) - count({c}) as nulls, round(avg({c}::double), 4) as mean,
     round(stddev_samp({c}::double), 4) as stddev, min({c})::double + 0.0 as min, max({c})::double + 0.0 as max from lineitem"""


PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query("a10_table_profile", " union all ".join(_profile_sql(c) for c in PROFILE_COLS))
def a10(spark, d):
    p = PR.profile(load(spark, d, "lineitem"), PROFILE_COLS)
    return p.select("column", "count", "nulls", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), (F.col("min") + 0.0).alias("min"), (F.col("max") + 0.0).alias("max"))


@query("a10_exact_quartiles", " union all ".join(f"""
select '{c}' as "column", round(quantile_cont({c}::double, 0.25), 4) as q1, round(quantile_cont({c}::double, 0.5), 4) as median, round(quantile_cont({c}::double, 0.75), 4) as q3 from lineitem""" for c in PROFILE_COLS))
def a10_exact(spark, d):
    p = PR.profile(load(spark, d, "lineitem"), PROFILE_COLS, approximate=False)
    return p.select("column", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")])


@query("a11_missing_values", """
select 'c_custkey' as "column", count(*) - count(c_custkey) as missing from customer union all
select 'seg', count(*) - count(nullif(c_mktsegment, 'BUILDING')) from customer union all
select 'bal', count(*) filter (c_acctbal < 0) from customer
""")
def a11(spark, d):
    c = load(spark, d, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("seg"), F.expr("case when c_acctbal >= 0 then c_acctbal end").alias("bal"))
    return PR.missing_values(c)


@query("a12_correlations", """
select 'l_quantity' as a, 'l_extendedprice' as b, round(corr(l_quantity, l_extendedprice), 6) as corr, round(var_pop(l_quantity), 4) as variance_a from lineitem union all
select 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6), round(var_pop(l_quantity), 4) from lineitem union all
select 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6), round(var_pop(l_extendedprice / 1000), 4) from lineitem
""")
def a12(spark, d):
    li = load(spark, d, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_tax"]
    v = PR.low_variance(li.withColumn("l_extendedprice", F.col("l_extendedprice") / 1000), cols)
    c = PR.correlations(li, cols)
    return c.join(v, c["a"] == v["column"]).select("a", "b", F.round("corr", 6).alias("corr"), F.round("variance", 4).alias("variance_a"))


@query("a13_histogram", "select cast(floor(value / 10) + 1 as integer) as bin, count(*) as n from events where value < 100 group by 1 union all select 11, count(*) from events where value >= 100 having count(*) > 0")
def a13(spark, d):
    return PR.histogram(load(spark, d, "events"), "value", 0.0, 100.0, 10)


COMBO_SQL = """
with b as (select distinct l_orderkey, {item} as item from lineitem {join}),
 c as (select l_orderkey, string_agg(item, ',' order by item) as combo from b group by l_orderkey),
 t as (select combo, count(*) as n_sales, min(l_orderkey) as first_sale from c group by combo order by n_sales desc, first_sale limit 20)
select t.n_sales, t.first_sale, b.item from t join b on b.l_orderkey = t.first_sale
"""


@query("a14_item_combinations", COMBO_SQL.format(item="p_brand", join="join part on l_partkey = p_partkey"))
def a14(spark, d):
    li, p = load(spark, d, "lineitem", "part")
    items = li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", F.col("p_brand").alias("item"))
    return gold.popular_combinations(items, "l_orderkey", "item", 20)


# --- windows, order, limits, union ------------------------------------------------------------------


@query("w01_latest_per_key", "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1")
def w01(spark, d):
    e = load(spark, d, "events")
    newest = F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id"))
    return e.groupBy("user_id").agg(newest.alias("x")).select("user_id", "x.*")


WIN = "partition by user_id order by ts, event_id"


@query("w02_next_sequence", f"select event_id, strftime(lead(ts) over ({WIN}), '%Y-%m-%d %H:%M:%S.%f') as next_ts from events")
def w02(spark, d):
    s = ordered_scan(load(spark, d, "events").select("user_id", "ts", "event_id"), ["user_id"], ["ts"], ["event_id"], lead={"next_ts": "ts"})
    return s.select("event_id", ts_text("next_ts").alias("next_ts"))


@query("w03_last_known_value", f"select event_id, last_value(nullif(event_type, 'view') ignore nulls) over ({WIN} rows between unbounded preceding and current row) as kind from events")
def w03(spark, d):
    e = load(spark, d, "events").select("user_id", "ts", "event_id", F.expr("nullif(event_type, 'view')").alias("k"))
    return ordered_scan(e, ["user_id"], ["ts"], ["event_id"], last={"kind": "k"}).select("event_id", "kind")


@query("w04_running_count", f"select event_id, cast(sum(case when event_type = 'error' then 1 else 0 end) over ({WIN} rows between unbounded preceding and current row) as bigint) as life from events")
def w04(spark, d):
    e = load(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "error").cast("long").alias("is_del"))
    return ordered_scan(e, ["user_id"], ["ts"], ["event_id"], running={"life": "is_del"}).select("event_id", "life")


@query("o01_order_by_desc", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders order by o_orderdate desc, o_orderkey")
def o01(spark, d):
    return load(spark, d, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").select("o_orderkey", day_text("o_orderdate").alias("day"))


@query("o02_sort_on_write", "select count(*) as n, true as sorted from orders")
def o02(spark, d):
    path = workdir(spark, "o02")
    load(spark, d, "orders").sortWithinPartitions("o_orderdate", "o_orderkey").write.parquet(path)
    r = spark.read.parquet(path).select("o_orderdate", "o_orderkey", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    # rows of a file in reading order: every row at or after the one before
    r = r.withColumn("i", F.monotonically_increasing_id())
    s = ordered_scan(r.withColumn("k", F.struct("o_orderdate", "o_orderkey")), ["f", "b"], ["i"], lead={"nxt": "k"})
    return s.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("nxt").isNull() | (F.col("k") <= F.col("nxt"))).alias("sorted"))


@query("o03_best_and_worst", """
(select 'best' as which, c_custkey, c_acctbal from customer where c_mktsegment = 'BUILDING' order by c_acctbal desc, c_custkey limit 1)
union all (select 'worst', c_custkey, c_acctbal from customer where c_mktsegment = 'BUILDING' order by c_acctbal, c_custkey limit 1)
""")
def o03(spark, d):
    c = load(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_acctbal")
    top = lambda which, *order: c.orderBy(*order).limit(1).select(F.lit(which).alias("which"), "*")
    return top("best", F.desc("c_acctbal"), "c_custkey").unionByName(top("worst", F.asc("c_acctbal"), "c_custkey"))


@query("o04_first_rows", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 5")
def o04(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("u01_union_all", "select s_suppkey as id, s_name as name from supplier union all select c_custkey, c_name from customer")
def u01(spark, d):
    s, c = load(spark, d, "supplier", "customer")
    a = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return a.unionByName(c.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")))
