"""Expectations, event log, quarantine and alerts."""

from __future__ import annotations

from ..operators import ml as M, quality as Q
from ..streaming.files import stream_files
from ..streaming.flows import Flow
from . import gold
from .registry import F, load, query, workdir

RULES = {"status is final": "o_orderstatus in ('F', 'O')", "price in range": "o_totalprice between 1000 and 400000"}
OK1, OK2 = RULES.values()
METRICS_SQL = f"""
select 'orders' as dataset, 'status is final' as name, count(*) filter ({OK1}) as passed_records, count(*) filter (not ({OK1})) as failed_records from orders
union all select 'orders', 'price in range', count(*) filter ({OK2}), count(*) filter (not ({OK2})) from orders
"""


def _orders(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("q01_expectation_keeps_rows", f"""
select count(*) as n_rows, count(*) filter (not ({OK1})) as failed_0, count(*) filter (not ({OK2})) as failed_1 from orders
""")
def q01(spark, d):
    base = workdir(spark, "q01")
    flow = Flow(spark, f"{base}/flow")
    _orders(spark, d).write.parquet(f"{base}/in")
    flow.stream(name="clean", expect=RULES)(lambda: stream_files(spark, f"{base}/in", "parquet", "o_orderkey long, o_orderstatus string, o_totalprice double"))
    flow.update()
    failed = {r.name: r.failed_records for r in Q.event_metrics(flow.event_log()).collect()}
    return flow.read("clean").agg(F.count(F.lit(1)).alias("n_rows")).withColumns({f"failed_{i}": F.lit(failed[k]).cast("long") for i, k in enumerate(RULES)})


@query("q02_drop_row", f"select o_orderkey, o_orderstatus, o_totalprice from orders where {OK1} and {OK2}")
def q02(spark, d):
    return Q.drop_violations(_orders(spark, d), RULES)


@query("q03_fail_update", f"select o_orderkey, o_orderstatus, o_totalprice, true as aborted from orders where {OK2}")
def q03(spark, d):
    base = workdir(spark, "q03")
    flow = Flow(spark, base)
    state = {"df": Q.drop_violations(_orders(spark, d), {"r": OK2})}

    @flow.table(expect_or_fail={"price in range": OK2})
    def checked():
        return state["df"]

    flow.update()
    state["df"] = _orders(spark, d)  # now with violations: the update fails and the table keeps its rows
    try:
        flow.update()
        aborted = False
    except Exception:
        aborted = True
    return flow.read("checked").withColumn("aborted", F.lit(aborted))


@query("q04_conditional_rule", """
select l_orderkey, l_linenumber, l_partkey, not (l_returnflag = 'A' and l_linestatus = 'O') as ok from lineitem
""")
def q04(spark, d):
    rule = next(iter(gold.item_rules("A").values()))
    li = load(spark, d, "lineitem").withColumns({"product_id": F.col("l_returnflag"), "product_ingredients": F.expr("nullif(l_linestatus, 'O')")})
    return li.select("l_orderkey", "l_linenumber", "l_partkey", Q.holds(rule).alias("ok"))


@query("q05_expectation_metrics", METRICS_SQL)
def q05(spark, d):
    return Q.metrics(_orders(spark, d), "orders", RULES)


@query("q06_event_log_metrics", METRICS_SQL.replace("'orders' as dataset", "'checked' as dataset").replace("select 'orders',", "select 'checked',"))
def q06(spark, d):
    flow = Flow(spark, workdir(spark, "q06"))
    flow.table(name="checked", expect=RULES)(lambda: _orders(spark, d))
    flow.update()
    return Q.event_metrics(flow.event_log()).drop("id")


@query("q06_event_log_by_day", """
select strftime(ts, '%Y-%m-%d') as id, 'events' as dataset, 'no error' as name, count(*) filter (event_type = 'error') as failed_records, count(*) filter (event_type <> 'error') as passed_records
from events group by 1 having count(*) filter (event_type <> 'signup') > 0
""")
def q06b(spark, d):
    e = load(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("id")).agg(
        F.count_if(F.col("event_type") == "error").alias("failed"), F.count_if(F.col("event_type") != "error").alias("passed"), F.count_if(F.col("event_type") != "signup").alias("rows"))
    exp = F.struct(F.lit("no error").alias("name"), F.lit("events").alias("dataset"), F.col("passed").alias("passed_records"), F.col("failed").alias("failed_records"))
    metrics = F.when(F.col("rows") > 0, F.struct(F.col("rows").alias("num_output_rows")))
    details = F.to_json(F.struct(F.struct(metrics.alias("metrics"), F.struct(F.array(exp).alias("expectations")).alias("data_quality")).alias("flow_progress")))
    return Q.event_metrics(e.select("id", details.alias("details")))


@query("q07_quarantine", f"""
select o_orderkey, case when not ({OK1}) and not ({OK2}) then 'status is final,price in range' when not ({OK1}) then 'status is final' else 'price in range' end as failed,
  (select count(*) from orders where {OK1} and {OK2}) as n_good from orders where not ({OK1}) or not ({OK2})
""")
def q07(spark, d):
    good, bad = Q.quarantine(_orders(spark, d), RULES)
    n = good.count()
    return bad.select("o_orderkey", F.concat_ws(",", "failed_rules").alias("failed"), F.lit(n).cast("long").alias("n_good"))


@query("q08_alert", """
select n_name as store_name, count(*) as canceled_per_store, 'TRIGGERED' as state from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
where o_orderstatus = 'P' group by 1 having count(*) > 200
""")
def q08(spark, d):
    o, c, n = load(spark, d, "orders", "customer", "nation")
    per = o.where("o_orderstatus = 'P'").join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    per = per.groupBy(F.col("n_name").alias("store_name")).agg(F.count(F.lit(1)).alias("canceled_per_store"))
    state, rows = Q.evaluate_alert(per, "canceled_per_store", ">", 200)
    return rows.withColumn("state", F.lit(state))


@query("q09_split_shares", """
with s as (select case when h <= 'b3333332' then 'train' when h <= 'e6666665' then 'valid' else 'test' end as split
  from (select substr(md5('42|' || o_orderkey::varchar), 1, 8) as h from orders))
select split, count(*) as n, abs(count(*)::double / (select count(*) from orders) - case split when 'train' then 0.7 when 'valid' then 0.2 else 0.1 end) <= 0.02 as within
from s group by split
""")
def q09(spark, d):
    s = M.split(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return Q.share_check(s, "split", {"train": 0.7, "valid": 0.2, "test": 0.1}, 0.02).select("split", "n", "within")
