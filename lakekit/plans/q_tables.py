"""Versioned datasets and table changes."""

from __future__ import annotations

from ..operators import changes as C
from ..operators.versioned import VersionedTable
from ..sources.files import create_view
from .registry import F, load, query, ts_text, workdir

COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
SQL_COLS = ", ".join(COLS)
STATUS_CASE = "case when o_orderstatus = 'F' then 'DONE' when o_orderstatus in ('O', 'P') then 'OPEN' end"


def _orders(spark, d):
    return load(spark, d, "orders").select(*COLS)


def _table(spark, d, label, **kw):
    return VersionedTable.create(_orders(spark, d), workdir(spark, label), key="o_orderkey", **kw)


def _history(t):
    return t.history().select("version", "operation", "n_rows")


@query("t01_commit_versions", """
select cast(0 as bigint) as version, 'CREATE' as operation, count(*) as n_rows from orders
union all select 1, 'WRITE', count(*) from orders where o_orderstatus <> 'P'
union all select 2, 'APPEND', count(*) from orders
""")
def t01(spark, d):
    t = _table(spark, d, "t01")
    o = _orders(spark, d)
    t.commit(o.where("o_orderstatus <> 'P'"))
    t.append(o.where("o_orderstatus = 'P'"))
    return _history(t)


@query("t02_update_case", f"select o_orderkey, o_custkey, case when o_orderpriority = '1-URGENT' then {STATUS_CASE} else o_orderstatus end as o_orderstatus, o_orderpriority from orders")
def t02(spark, d):
    return C.update(_orders(spark, d), {"o_orderstatus": STATUS_CASE}, "o_orderpriority = '1-URGENT'")


@query("t03_delete_where", f"select {SQL_COLS} from orders where not (o_orderstatus = 'P')")
def t03(spark, d):
    return C.delete(_orders(spark, d), "o_orderstatus = 'P'")


@query("t04_append_subset", f"""
select {SQL_COLS} from orders union all select o_orderkey + 1000000000, null, o_orderstatus, null from orders where o_orderstatus = 'P'
""")
def t04(spark, d):
    o = _orders(spark, d)
    more = o.where("o_orderstatus = 'P'").select(F.col("o_orderkey") + 1_000_000_000, "o_orderstatus")
    return C.append(o, more, ["o_orderkey", "o_orderstatus"])


MERGE_SRC = """(select c_custkey, c_name || '*' as c_name, c_mktsegment from customer where c_acctbal < 1000
  union all select c_custkey + 1000000000, c_name, c_mktsegment from customer where c_acctbal > 9000)"""


def _merge_source(c):
    changed = c.where("c_acctbal < 1000").select("c_custkey", F.concat("c_name", F.lit("*")).alias("c_name"), "c_mktsegment")
    return changed.unionByName(c.where("c_acctbal > 9000").select((F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_name", "c_mktsegment"))


@query("t05_merge_upsert", f"""
select c.c_custkey, coalesce(s.c_name, c.c_name) as c_name, coalesce(s.c_mktsegment, c.c_mktsegment) as c_mktsegment
from customer c left join {MERGE_SRC} s on s.c_custkey = c.c_custkey
union all select s.c_custkey, s.c_name, s.c_mktsegment from {MERGE_SRC} s where s.c_custkey not in (select c_custkey from customer)
""")
def t05(spark, d):
    c = load(spark, d, "customer")
    return C.merge(c.select("c_custkey", "c_name", "c_mktsegment"), _merge_source(c), "c_custkey")


@query("t05_merge_into_stored_table", f"""
select c.c_custkey, coalesce(s.c_name, c.c_name) as c_name, coalesce(s.c_mktsegment, c.c_mktsegment) as c_mktsegment
from customer c left join {MERGE_SRC} s on s.c_custkey = c.c_custkey
union all select s.c_custkey, s.c_name, s.c_mktsegment from {MERGE_SRC} s where s.c_custkey not in (select c_custkey from customer)
""")
def t05b(spark, d):
    c = load(spark, d, "customer")
    t = VersionedTable.create(c.select("c_custkey", "c_name", "c_mktsegment"), workdir(spark, "t05b"), key="c_custkey", partition_by="c_mktsegment")
    t.merge(_merge_source(c), "c_custkey")
    return t.read()


@query("t06_merge_insert_only", f"""
select c_custkey, c_name, c_mktsegment from customer
union all select s.c_custkey, s.c_name, s.c_mktsegment from {MERGE_SRC} s where s.c_custkey not in (select c_custkey from customer)
""")
def t06(spark, d):
    c = load(spark, d, "customer")
    return C.merge(c.select("c_custkey", "c_name", "c_mktsegment"), _merge_source(c), "c_custkey", matched=None)


@query("t07_add_column", """
select n_rows.version, n_rows.has_country, n_rows.n from (
 select cast(0 as bigint) as version, false as has_country, count(*) as n from orders
 union all select 1, true, count(*) from orders) n_rows
""")
def t07(spark, d):
    t = _table(spark, d, "t07")
    t.add_column("country", "string")
    one = lambda v: t.read(v).agg(F.lit(v).cast("long").alias("version"), F.lit("country" in t.read(v).columns).alias("has_country"), F.count(F.lit(1)).alias("n"))
    return one(0).unionByName(one(1))


@query("t08_rename_and_comment", """
select 'o_orderkey' as old_name, 'order_id' as new_name, 'unique id' as comment, count(*) as n, sum(o_orderkey)::bigint as total from orders
""")
def t08(spark, d):
    t = _table(spark, d, "t08")
    t.rename_column("o_orderkey", "order_id")
    t.comment_column("order_id", "unique id")
    df = t.read()
    return df.agg(
        F.lit(t.read(0).columns[0]).alias("old_name"), F.lit(df.columns[0]).alias("new_name"), F.lit(df.schema["order_id"].metadata["comment"]).alias("comment"),
        F.count(F.lit(1)).alias("n"), F.sum("order_id").alias("total"),
    )


@query("t10_constraint_rejects", f"select {SQL_COLS}, true as rejected from orders")
def t10(spark, d):
    t = _table(spark, d, "t10")
    t.not_null("o_orderkey")
    rejected = False
    try:
        t.append(_orders(spark, d).where("o_orderstatus = 'P'").withColumn("o_orderkey", F.lit(None).cast("long")))
    except ValueError:
        rejected = True
    return t.read().withColumn("rejected", F.lit(rejected))


@query("t11_history", """
select cast(0 as bigint) as version, 'CREATE' as operation, count(*) as n_rows from orders
union all select 1, 'UPDATE', count(*) from orders
union all select 2, 'DELETE', count(*) from orders where o_orderstatus <> 'P'
union all select 3, 'ENABLE CHANGE FEED', count(*) from orders where o_orderstatus <> 'P'
""")
def t11(spark, d):
    t = _table(spark, d, "t11", partition_by="o_orderpriority")
    t.update({"o_custkey": "0"}, "o_orderpriority = '5-LOW'")
    t.delete("o_orderstatus = 'P'")
    t.enable_change_feed()
    return _history(t)


@query("t12_read_version", f"select {SQL_COLS} from orders")
def t12(spark, d):
    t = _table(spark, d, "t12", partition_by="o_orderstatus")
    t.delete("o_orderstatus = 'F'")
    t.update({"o_custkey": "-1"}, "o_orderstatus = 'O'")
    return t.read(version=0)


@query("t13_read_timestamp", f"select {SQL_COLS} from orders where o_orderstatus <> 'F'")
def t13(spark, d):
    t = _table(spark, d, "t13", partition_by="o_orderstatus")
    t.delete("o_orderstatus = 'F'")
    at = t.history().where("version = 1").select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    t.update({"o_custkey": "-1"}, "o_orderstatus = 'O'")
    return t.read(timestamp=at)


@query("t14_version_anti_join", f"select {SQL_COLS} from orders where o_orderstatus = 'P'")
def t14(spark, d):
    o = _orders(spark, d)
    t = VersionedTable.create(o.where("o_orderstatus <> 'P'"), workdir(spark, "t14"), key="o_orderkey")
    t.append(o.where("o_orderstatus = 'P'"))
    return t.version_anti_join(0, "o_orderkey")


FEED_SQL = f"""
select {SQL_COLS}, 'update_preimage' as _change_type, cast(1 as bigint) as _commit_version from orders where o_orderstatus = 'O'
union all select o_orderkey, o_custkey, 'X', o_orderpriority, 'update_postimage', 1 from orders where o_orderstatus = 'O'
union all select {SQL_COLS}, 'delete', 2 from orders where o_orderstatus = 'P'
union all select o_orderkey + 1000000000, o_custkey, o_orderstatus, o_orderpriority, 'insert', 3 from orders where o_orderstatus = 'F'
"""


def _fed(spark, d, label, **kw):
    t = _table(spark, d, label, change_feed=True, **kw)
    t.update({"o_orderstatus": "'X'"}, "o_orderstatus = 'O'")
    t.delete("o_orderstatus = 'P'")
    t.append(_orders(spark, d).where("o_orderstatus = 'F'").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000))
    return t


@query("t15_change_feed_versions", FEED_SQL)
def t15(spark, d):
    return _fed(spark, d, "t15").changes(1).drop("_commit_timestamp")


@query("t16_change_feed_timestamps", FEED_SQL)
def t16(spark, d):
    t = _fed(spark, d, "t16", partition_by="o_orderpriority")
    at = {r.version: r.t for r in t.history().select("version", ts_text("timestamp").alias("t")).collect()}
    return t.changes(start_ts=at[1], end_ts=at[3]).drop("_commit_timestamp")


@query("t17_snapshot_diff", """
with o as (select o_orderkey, o_orderstatus, o_orderpriority from orders where o_totalprice < 400000),
     n as (select o_orderkey, case when o_orderpriority = '5-LOW' then 'X' else o_orderstatus end as o_orderstatus, o_orderpriority from orders where o_totalprice >= 50000)
select n.*, 'insert' as _change_type from n left join o using (o_orderkey) where o.o_orderkey is null
union all select o.*, 'delete' from o left join n using (o_orderkey) where n.o_orderkey is null
union all select o.*, 'update_preimage' from o join n using (o_orderkey) where o.o_orderstatus is distinct from n.o_orderstatus
union all select n.*, 'update_postimage' from o join n using (o_orderkey) where o.o_orderstatus is distinct from n.o_orderstatus
""")
def t17(spark, d):
    o = load(spark, d, "orders")
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    new = C.update(o.where("o_totalprice >= 50000").select(*cols), {"o_orderstatus": "'X'"}, "o_orderpriority = '5-LOW'")
    return C.diff(o.where("o_totalprice < 400000").select(*cols), new, "o_orderkey")


@query("t17_diff_of_repeated_keys", """
select l_orderkey, l_quantity, l_returnflag, 'update_preimage' as _change_type from lineitem where l_linenumber = 1 and l_orderkey % 2 = 0
union all select l_orderkey, l_quantity + 1000, l_returnflag, 'update_postimage' from lineitem where l_linenumber = 1 and l_orderkey % 2 = 0
union all select l_orderkey, l_quantity, l_returnflag, 'delete' from lineitem where l_linenumber = 3 and l_orderkey % 2 = 1
""")
def t17_repeated(spark, d):
    """One line of even orders changed, one of odd orders gone; the other lines of these keys are no change."""
    li = load(spark, d, "lineitem").where("l_linenumber <> 2")
    new = C.update(li.where("l_linenumber <> 3 or l_orderkey % 2 = 0"), {"l_quantity": "l_quantity + 1000"}, "l_linenumber = 1 and l_orderkey % 2 = 0")
    cols = ["l_orderkey", "l_quantity", "l_returnflag"]
    return C.diff(li.select(*cols), new.select(*cols), "l_orderkey")


@query("t18_feed_starts_when_enabled", f"select {SQL_COLS}, 'delete' as _change_type, cast(2 as bigint) as _commit_version, true as refused from orders where o_orderstatus = 'P'")
def t18(spark, d):
    t = _table(spark, d, "t18")
    t.enable_change_feed()
    t.delete("o_orderstatus = 'P'")
    try:
        t.changes(0)
        refused = False
    except ValueError:
        refused = True
    return t.changes(1).drop("_commit_timestamp").withColumn("refused", F.lit(refused))


@query("t19_deep_clone", f"select {SQL_COLS} from orders")
def t19(spark, d):
    t = _table(spark, d, "t19")
    t.delete("o_orderstatus = 'F'")
    c = t.clone(workdir(spark, "t19c"), version=0)
    t.delete()
    return c.read()


@query("t20_shallow_clone", f"select {SQL_COLS} from orders where o_orderstatus <> 'P' and o_orderstatus <> 'F'")
def t20(spark, d):
    t = _table(spark, d, "t20", partition_by="o_orderstatus")
    t.delete("o_orderstatus = 'P'")
    c = t.clone(workdir(spark, "t20c"), deep=False)
    c.delete("o_orderstatus = 'F'")
    return c.read()


@query("t21_describe_and_detail", """
select 'o_orderkey' as col_name, 'bigint' as data_type, (select count(*) from orders) as n_rows, true as has_files
union all select 'o_custkey', 'bigint', (select count(*) from orders), true
union all select 'o_orderstatus', 'string', (select count(*) from orders), true
union all select 'o_orderpriority', 'string', (select count(*) from orders), true
""")
def t21(spark, d):
    t = _table(spark, d, "t21")
    det = t.detail().first()
    return t.describe().select("col_name", "data_type", F.lit(det.n_rows).cast("long").alias("n_rows"), F.lit(det.num_files > 0 and det.size_in_bytes > 0).alias("has_files"))


@query("t23_view", "select o_orderstatus, count(*) as n from orders where o_orderpriority = '1-URGENT' group by o_orderstatus")
def t23(spark, d):
    create_view(load(spark, d, "orders"), "lk_orders_view")
    return spark.sql("select o_orderstatus, count(*) as n from lk_orders_view where o_orderpriority = '1-URGENT' group by o_orderstatus")
