"""Change data capture and slowly changing dimensions."""

from __future__ import annotations

from ..operators import scd
from ..streaming.changes import ChangeTarget
from .registry import F, load, query, ts_text, workdir

KIND_SQL = "case when event_type in ('error', 'view') then null else event_type end"


def change_log(spark, d):
    """Events as the change log of a user dimension: 'error' deletes the user, 'view' brings a NULL kind."""
    kind = F.when(~F.col("event_type").isin("error", "view"), F.col("event_type"))
    return load(spark, d, "events").select(
        "user_id", "ts", "event_id", kind.alias("kind"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "error", "delete").otherwise("update").alias("_change_type"))


LOG_DDL = "user_id long, ts timestamp_ntz, event_id long, kind string, value double, _change_type string"
CONTROL = ["event_id", "_change_type"]
FILE_ROWS = 1_000_000

LI_KEY = ["l_orderkey", "l_linenumber"]
LI_REST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LI_ORDER = ", ".join(f"{c} desc" for c in ["l_shipdate", "l_extendedprice", "l_partkey", "l_quantity", "l_suppkey"])


@query("c01_scd1_newest_row", f"""
select l_orderkey, l_linenumber, l_partkey, l_extendedprice from
 (select *, row_number() over (partition by l_orderkey, l_linenumber order by {LI_ORDER}) as rn from lineitem) where rn = 1
""")
def c01(spark, d):
    log = load(spark, d, "lineitem").select(*LI_KEY, *LI_REST)
    return scd.apply_changes(log, LI_KEY, "l_shipdate", tie_by=["l_extendedprice", "l_partkey", "l_quantity", "l_suppkey"]).select(*LI_KEY, "l_partkey", "l_extendedprice")


@query("c02_composite_sequence", """
select l_orderkey, l_partkey, l_extendedprice from (select *, row_number() over (partition by l_orderkey
 order by l_shipdate desc, l_linenumber desc, l_extendedprice desc, l_partkey desc) as rn from lineitem) where rn = 1
""")
def c02(spark, d):
    log = load(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_extendedprice", "l_partkey")
    return scd.apply_changes(log, "l_orderkey", ["l_shipdate", "l_linenumber"]).select("l_orderkey", "l_partkey", "l_extendedprice")


C03_SQL = f"""
with filled as (select user_id, ts, last_value({KIND_SQL} ignore nulls) over (partition by user_id order by ts, event_id
  rows between unbounded preceding and current row) as kind, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
select user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, kind from filled where rn = 1
"""


@query("c03_scd1_ignore_nulls", C03_SQL)
def c03(spark, d):
    log = change_log(spark, d).select("user_id", "ts", "event_id", "kind")
    return scd.apply_changes(log, "user_id", "ts", ignore_null_updates=True, tie_by="event_id").select("user_id", ts_text("ts").alias("ts"), "kind")


SCD2_SQL = f"""
with log as (select user_id, ts, event_id, event_type = 'error' as is_del, {KIND_SQL} as kind, case when event_type <> 'error' then value end as value,
    sum(case when event_type = 'error' then 1 else 0 end) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as life,
    lead(ts) over (partition by user_id order by ts, event_id) as end_at from events),
 f as (select user_id, is_del, last_value(kind ignore nulls) over (partition by user_id, life order by ts, event_id rows between unbounded preceding and current row) as kind,
    value, ts as start_at, end_at from log)
"""
SCD2_OUT = "strftime(start_at, '%Y-%m-%d %H:%M:%S.%f') as start_at, strftime(end_at, '%Y-%m-%d %H:%M:%S.%f') as end_at"


def history(spark, d, ignore_null=True, log=None):
    log = change_log(spark, d) if log is None else log
    return scd.apply_changes(log, "user_id", "ts", "_change_type = 'delete'", ignore_null, CONTROL + ["ts"], 2, "event_id")


def _out(h, *cols):
    return h.select("user_id", *cols, ts_text(scd.START).alias("start_at"), ts_text(scd.END).alias("end_at"))


@query("c04_scd2_intervals", f"""
select user_id, event_type as kind, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as start_at,
  strftime(lead(ts) over (partition by user_id order by ts, event_id), '%Y-%m-%d %H:%M:%S.%f') as end_at from events
""")
def c04(spark, d):
    log = load(spark, d, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("kind"))
    return _out(scd.apply_changes(log, "user_id", "ts", except_cols=["ts", "event_id"], scd_type=2, tie_by="event_id"), "kind")


@query("c05_scd2_deletes", SCD2_SQL.replace("last_value(kind ignore nulls) over (partition by user_id, life order by ts, event_id rows between unbounded preceding and current row)", "kind") + f"select user_id, kind, {SCD2_OUT} from f where not is_del")
def c05(spark, d):
    return _out(history(spark, d, ignore_null=False), "kind")


@query("c06_scd2_ignore_nulls", SCD2_SQL + f"select user_id, kind, value, {SCD2_OUT} from f where not is_del")
def c06(spark, d):
    return _out(history(spark, d), "kind", "value")


@query("c07_except_columns", f"select * exclude (ts, rn) from (select user_id, ts, {KIND_SQL} as kind, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1")
def c07(spark, d):
    log = change_log(spark, d).drop("value")
    return scd.apply_changes(log, "user_id", "ts", except_cols=["ts", *CONTROL], tie_by="event_id")


@query("c08_sequence_ties", """
select user_id, strftime(day, '%Y-%m-%d') as start_at, strftime(lead(day) over (partition by user_id order by day), '%Y-%m-%d') as end_at, event_type as kind from
 (select user_id, date_trunc('day', ts) as day, event_type, row_number() over (partition by user_id, date_trunc('day', ts) order by event_id desc) as rn from events) where rn = 1
""")
def c08(spark, d):
    log = load(spark, d, "events").select("user_id", F.date_trunc("day", "ts").alias("day"), "event_id", F.col("event_type").alias("kind"))
    h = scd.apply_changes(log, "user_id", "day", except_cols=["day", "event_id"], scd_type=2, tie_by="event_id")
    return h.select("user_id", F.date_format(scd.START, "yyyy-MM-dd").alias("start_at"), F.date_format(scd.END, "yyyy-MM-dd").alias("end_at"), "kind")


def _batches(spark, d, label, **kw):
    """The change log as files in an order that is not the order of the changes, then micro-batches over them."""
    base = workdir(spark, label)
    log = change_log(spark, d)
    for i, types in enumerate([["purchase", "view"], ["error"], ["click", "signup"]]):
        ids = load(spark, d, "events").where(F.col("event_type").isin(types)).select("event_id")
        files = ids.count() // FILE_ROWS + 1  # and not as many as the join has partitions
        log.join(ids, "event_id", "left_semi").select(*log.columns).repartition(files).write.parquet(f"{base}/in/b{i}")
    target = ChangeTarget(spark, f"{base}/target", "user_id", "ts", LOG_DDL, delete_when="_change_type = 'delete'", ignore_null_updates=True, tie_by="event_id", buckets=8, **kw)
    stream = spark.readStream.schema(LOG_DDL).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    target.run(stream, f"{base}/checkpoint")
    return target.read()


@query("c09_streaming_scd1", SCD2_SQL + f"select user_id, kind, value, strftime(start_at, '%Y-%m-%d %H:%M:%S.%f') as ts from f where not is_del and end_at is null")
def c09(spark, d):
    return _batches(spark, d, "c09", except_cols=CONTROL).select("user_id", "kind", "value", ts_text("ts").alias("ts"))


@query("c09_streaming_scd2", SCD2_SQL + f"select user_id, kind, value, {SCD2_OUT} from f where not is_del")
def c09b(spark, d):
    return _out(_batches(spark, d, "c09b", except_cols=CONTROL + ["ts"], scd_type=2), "kind", "value")


@query("c10_snapshot_feed", "select p_partkey as id, p_name as name, 'insert' as _change_type, '2023-01-01 00:00:00.000' as _change_timestamp from part")
def c10(spark, d):
    p = load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return scd.snapshot_feed(p, "insert", "2023-01-01 00:00:00.000")


@query("c11_dimension_as_of", SCD2_SQL + """
select e.event_id, f.kind from (select event_id, user_id, ts + interval 90 second as at from events) e
left join (select * from f where not is_del) f on e.user_id = f.user_id and e.at >= f.start_at and (f.end_at is null or e.at < f.end_at)
""")
def c11(spark, d):
    facts = load(spark, d, "events").select("event_id", "user_id", F.expr("ts + interval 90 seconds").alias("at"))
    return scd.as_of_join(facts, history(spark, d), "user_id", "at", columns=["kind"]).select("event_id", "kind")
