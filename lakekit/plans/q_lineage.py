"""Lineage. Data-sized edge tables are derived from the star schema: which supplier feeds which order."""

from __future__ import annotations

from ..operators import lineage as L
from ..streaming.flows import Flow
from . import gold
from .registry import F, load, query, workdir


def _edges(spark, d):
    """region -> nation -> customer -> order"""
    r, n, c, o = load(spark, d, "region", "nation", "customer", "orders")
    name = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    e = lambda df, a, b, at=None: df.select(a.alias("source"), b.alias("target"), (F.col(at) if at else F.lit(None)).cast("timestamp").alias("at"))
    return (
        e(n, name("r", "n_regionkey"), name("n", "n_nationkey"))
        .unionByName(e(c, name("n", "c_nationkey"), name("c", "c_custkey")))
        .unionByName(e(o, name("c", "o_custkey"), name("o", "o_orderkey"), "o_orderdate"))
    )


@query("l01_table_lineage", """
select s as source, t as target, (select count(*) from part) as n_rows from (values ('menu', 'dinner'), ('dinner', 'dinner_price'), ('price', 'dinner_price')) x(s, t)
""")
def l01(spark, d):
    flow, p = Flow(spark, workdir(spark, "l01")), load(spark, d, "part")
    flow.table("dinner_price")(lambda: gold.dinner_price(flow.read("dinner"), flow.read("price")))
    flow.table("dinner")(lambda: gold.dinner(flow.read("menu")))
    flow.table("menu")(lambda: p.select(F.col("p_partkey").alias("recipe_id"), F.col("p_name").alias("app"), F.col("p_brand").alias("main"), F.col("p_type").alias("desert")))
    flow.table("price")(lambda: p.select(F.col("p_partkey").alias("recipe_id"), F.col("p_retailprice").alias("price")))
    flow.update()
    n = flow.read("dinner_price").count()
    return flow.edges().select("source", "target", F.lit(n).cast("long").alias("n_rows"))


@query("l02_column_lineage", """
select 'part' as source, c as source_column, 'dinner' as target, 'full_menu' as target_column, (select count(*) from part where p_name || ' + ' || p_brand || ' + ' || p_type is not null) as n_rows
from (values ('p_name'), ('p_brand'), ('p_type')) x(c)
""")
def l02(spark, d):
    p = load(spark, d, "part")
    menu = p.select(F.col("p_partkey").alias("recipe_id"), F.col("p_name").alias("app"), F.col("p_brand").alias("main"), F.col("p_type").alias("desert"))
    dinner = gold.dinner(menu)
    e = L.column_edges("dinner", {"full_menu": ["part.p_name", "part.p_brand", "part.p_type"]}, {"part": p, "dinner": dinner})
    n = dinner.where("full_menu is not null").count()
    return e.withColumn("n_rows", F.lit(n).cast("long"))


@query("l03_downstream_closure", """
select 'n' || n_nationkey as node, cast(1 as integer) as depth from nation where n_regionkey = 2
union all select 'c' || c_custkey, 2 from customer join nation on c_nationkey = n_nationkey where n_regionkey = 2
union all select 'o' || o_orderkey, 3 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where n_regionkey = 2
""")
def l03(spark, d):
    return L.closure(_edges(spark, d), ["r2"])


@query("l04_redacted_names", """
select case when c_nationkey = s.s_nationkey then 'c' || c_custkey else 'REDACTED' end as node, 'n' || c_nationkey as source from customer,
 (select s_nationkey from supplier where s_name = 'Supplier#000000003') s
""")
def l04(spark, d):
    c, s = load(spark, d, "customer", "supplier")
    nodes = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("source"))
    grants = s.join(c, s.s_nationkey == c.c_nationkey).select(F.col("s_name").alias("user"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("name"))
    return L.redact(nodes, grants, "Supplier#000000003")


@query("l05_recent_edges", """
select 'c' || o_custkey as source, 'o' || o_orderkey as target, strftime(o_orderdate, '%Y-%m-%d') as day from orders
where o_orderdate > timestamp '1998-06-30' - interval 30 day and o_orderdate <= timestamp '1998-06-30'
""")
def l05(spark, d):
    return L.recent(_edges(spark, d), "1998-06-30").select("source", "target", F.date_format("at", "yyyy-MM-dd").alias("day"))
