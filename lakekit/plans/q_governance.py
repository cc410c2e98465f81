"""Row filters and masking. Groups and permissions are derived from suppliers and their home region."""

from __future__ import annotations

from ..operators import governance as G
from ..operators.versioned import VersionedTable
from .registry import F, load, query, workdir

WHO = "Supplier#000000003"
# groups of a reader: one per nation of the reader's home region
HOME_SQL = f"(select b.n_name, b.n_nationkey, b.n_regionkey from supplier join nation a on s_nationkey = a.n_nationkey join nation b on a.n_regionkey = b.n_regionkey where s_name = '{WHO}')"


def _customers(spark, d):
    c, n = load(spark, d, "customer", "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "c_name", F.col("n_name").alias("country"), "c_mktsegment")


def _home(spark, d):
    s, n = load(spark, d, "supplier", "nation")
    home = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_name").alias("user"), F.col("n_regionkey").alias("r"))
    return home.join(n, home.r == n.n_regionkey).select("user", "n_name", "r")


def _memberships(spark, d):
    return _home(spark, d).select("user", F.concat(F.lit("ANALYST_"), "n_name").alias("group_name"))


def _permissions(spark, d):
    return _home(spark, d).select(F.col("user").alias("analyst_email"), F.col("n_name").alias("country_filter"), (F.substring("n_name", -1, 1).cast("int") % 2).alias("gdpr_filter"))


GROUP = lambda: F.concat(F.lit("ANALYST_"), F.col("country"))


@query("g01_row_filter_by_group", f"select c_custkey, n_name as country from customer join nation on c_nationkey = n_nationkey where n_name in (select n_name from {HOME_SQL})")
def g01(spark, d):
    return G.row_filter(_customers(spark, d), GROUP(), _memberships(spark, d), WHO).select("c_custkey", "country")


@query("g02_membership_flag", f"select c_custkey, n_name in (select n_name from {HOME_SQL}) as is_member from customer join nation on c_nationkey = n_nationkey")
def g02(spark, d):
    return G.membership_flag(_customers(spark, d), GROUP(), _memberships(spark, d), WHO).select("c_custkey", "is_member")


PERM_SQL = f"(select n_name, cast(right(n_name, 1) as integer) % 2 as gdpr_filter from {HOME_SQL})"


@query("g03_permission_table_filter", f"select c_custkey, p.gdpr_filter from customer join nation n on c_nationkey = n.n_nationkey join {PERM_SQL} p on p.n_name = n.n_name")
def g03(spark, d):
    return G.permission_filter(_customers(spark, d), _permissions(spark, d), "country", WHO).select("c_custkey", "gdpr_filter")


VIEW_SQL = f"""select c_custkey, n.n_name as country, case when p.gdpr_filter = 1 then sha1(c_name) else c_name end as c_name
 from customer join nation n on c_nationkey = n.n_nationkey join {PERM_SQL} p on p.n_name = n.n_name"""


@query("g04_masked_view", VIEW_SQL)
def g04(spark, d):
    return G.secure_view(_customers(spark, d), _permissions(spark, d), "country", ["c_custkey", "country"], ["c_name"], WHO)


@query("g05_permission_change", VIEW_SQL.replace("case when p.gdpr_filter = 1 then sha1(c_name) else c_name end", "sha1(c_name)"))
def g05(spark, d):
    t = VersionedTable.create(_permissions(spark, d), workdir(spark, "g05"))
    view = lambda: G.secure_view(_customers(spark, d), t.read(), "country", ["c_custkey", "country"], ["c_name"], WHO)
    view()
    t.update({"gdpr_filter": "1"}, f"analyst_email = '{WHO}'")
    return view()


@query("g06_own_permissions", f"select '{WHO}' as analyst_email, n_name as country_filter, gdpr_filter from {PERM_SQL}")
def g06(spark, d):
    return G.own_permissions(_permissions(spark, d), WHO)
