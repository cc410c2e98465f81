"""Streaming tables, live tables and dataset flows."""

from __future__ import annotations

from ..functions import udfs as D
from ..functions.nested import parse_items
from ..sources import generate as G
from ..streaming.files import run_available_now, stream_files
from ..streaming.flows import Flow
from .registry import F, load, query, workdir

EVENT_DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _event_files(spark, d, base, *types):
    """Events written as files, one folder per call, for a file stream to pick up."""
    load(spark, d, "events").where(F.col("event_type").isin(*types)).write.parquet(f"{base}/in/{'_'.join(types)}")


def _bronze(flow, spark, base):
    @flow.stream(comment="raw events", properties={"quality": "bronze"})
    def bronze():
        return stream_files(spark, f"{base}/in/*", "parquet", EVENT_DDL)


@query("x01_streaming_table", "select event_id, user_id, event_type from events")
def x01(spark, d):
    base = workdir(spark, "x01")
    flow = Flow(spark, f"{base}/flow")
    _bronze(flow, spark, base)
    _event_files(spark, d, base, "view", "click")
    flow.update()
    _event_files(spark, d, base, "error", "purchase", "signup")
    flow.update()
    return flow.read("bronze").select("event_id", "user_id", "event_type")


@query("x02_live_table", "select event_type, count(*) as n from events group by event_type")
def x02(spark, d):
    base = workdir(spark, "x02")
    flow = Flow(spark, f"{base}/flow")
    _bronze(flow, spark, base)

    @flow.table(comment="recomputed at every update")
    def per_type():
        return flow.read("bronze").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))

    _event_files(spark, d, base, "view", "click")
    flow.update()
    _event_files(spark, d, base, "error", "purchase", "signup")
    flow.update()
    return flow.read("per_type")


@query("x03_stream_and_full_reads", "select event_id, user_id, (select count(*) from events where event_type <> 'error') as total from events where event_type <> 'error'")
def x03(spark, d):
    base = workdir(spark, "x03")
    flow = Flow(spark, f"{base}/flow")
    _bronze(flow, spark, base)

    @flow.stream()
    def silver():
        return flow.read_stream("bronze").where("event_type <> 'error'").select("event_id", "user_id")

    @flow.table()
    def total():
        return flow.read("silver").agg(F.count(F.lit(1)).alias("total"))

    _event_files(spark, d, base, "view", "click", "error")
    flow.update()
    _event_files(spark, d, base, "purchase", "signup")
    flow.update()
    n = flow.read("total").first()[0]
    return flow.read("silver").withColumn("total", F.lit(n).cast("long"))


@query("x04_dataset_registration", """
select 'bronze' as source, 'per_user' as target, count(distinct user_id) as users from events
union all select 'per_user', 'top_users', count(distinct user_id) from events
""")
def x04(spark, d):
    flow = Flow(spark, workdir(spark, "x04"))

    # declared before its input: the order follows from the reads
    @flow.table()
    def top_users():
        return flow.read("per_user").agg(F.count(F.lit(1)).alias("users"))

    @flow.table(comment="events per user")
    def per_user():
        return flow.read("bronze").groupBy("user_id").count()

    @flow.table()
    def bronze():
        return load(spark, d, "events").select("event_id", "user_id")

    flow.update()
    users = flow.read("top_users").first()[0]
    return flow.edges().select("source", "target", F.lit(users).cast("long").alias("users"))


@query("x05_stateless_transforms", """
select o_orderkey || '-' || pos as id, o_orderkey as sale_id, pos as item_number, word as product_id from
 (select l_orderkey as o_orderkey, cast(0 as integer) as pos, l_returnflag as word, l_linenumber, l_partkey from lineitem
  union all select l_orderkey, 1, l_linestatus, l_linenumber, l_partkey from lineitem)
""")
def x05(spark, d):
    base = workdir(spark, "x05")
    item = lambda c: F.struct(F.col(c).alias("id"))
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("sale_id"), F.to_json(F.array(item("l_returnflag"), item("l_linestatus"))).alias("sale_items"))
    li.write.json(f"{base}/in")
    sdf = stream_files(spark, f"{base}/in", "json", "sale_id long, sale_items string")
    x = parse_items(sdf, "sale_items", "id: STRING", ["sale_id"])
    x = x.select(F.concat(F.col("sale_id").cast("string"), F.lit("-"), F.col("pos").cast("string")).alias("id"), "sale_id", F.col("pos").alias("item_number"), F.col("id").alias("product_id"))
    run_available_now(x, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("x06_triggered_and_continuous", "select event_id, event_type from events")
def x06(spark, d):
    base = workdir(spark, "x06")
    flow = Flow(spark, f"{base}/flow")
    _bronze(flow, spark, base)
    _event_files(spark, d, base, "view", "click")
    flow.update()
    flow.update(continuous="1 second")
    try:
        _event_files(spark, d, base, "error", "purchase", "signup")
        for q in flow.queries:
            q.processAllAvailable()
    finally:
        flow.stop()
    return flow.read("bronze").select("event_id", "event_type")


@query("x07_full_refresh", "select event_type, count(*) as n from events group by event_type")
def x07(spark, d):
    base = workdir(spark, "x07")
    flow = Flow(spark, f"{base}/flow")
    _bronze(flow, spark, base)
    _event_files(spark, d, base, "view", "click")
    flow.update()
    _event_files(spark, d, base, "error", "purchase", "signup")
    flow.update(full_refresh=True)
    return flow.read("bronze").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("x09_later_batches", """
select (select count(*) from supplier) as stores, cast(12 as bigint) as slots, true as one_store_each, true as ids_unique
""")
def x09(spark, d):
    s, p = load(spark, d, "supplier", "part")
    stores = s.select(F.col("s_name").alias("store_id"), F.lit("AU").alias("country"))
    products = sorted(r[0] for r in p.select("p_brand").distinct().collect())
    b = G.more_orders(stores, "2024-01-08", products, 1).withColumn("b", F.lit(1)).unionByName(G.more_orders(stores, "2024-01-08", products, 2).withColumn("b", F.lit(2)))
    per = b.groupBy("b", "ts").agg(F.count_distinct("store_id").alias("st"), F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))
    return per.agg(F.lit(stores.count()).cast("long").alias("stores"), F.count(F.lit(1)).alias("slots"), (F.max("st") == 1).alias("one_store_each"), F.bool_and(F.col("n") == F.col("ids")).alias("ids_unique"))


@query("x10_batch_scoring_in_flow", """
select l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(-(0.05 * l_quantity - 2 * l_discount - 0.5))), 6) as quality_predictions from lineitem
""")
def x10(spark, d):
    flow = Flow(spark, workdir(spark, "x10"))
    model = D.model_function(D.linear_predictor([0.05, -2.0], -0.5), ["l_quantity", "l_discount"])
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount"]
    for part, cond in {"training": "l_returnflag = 'A'", "validation": "l_returnflag <> 'A'"}.items():
        flow.table(name=f"{part}_data")(lambda cond=cond: load(spark, d, "lineitem").where(cond).select(*cols))
        flow.table(name=f"predict_{part}")(lambda part=part: flow.read(f"{part}_data").withColumn("quality_predictions", model("l_quantity", "l_discount")))
    flow.table(name="all_predictions")(lambda: flow.read("predict_training").unionByName(flow.read("predict_validation")))
    flow.update()
    return flow.read("all_predictions").select("l_orderkey", "l_linenumber", "l_partkey", F.round("quality_predictions", 6).alias("quality_predictions"))
