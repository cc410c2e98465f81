"""Row filters and column masking.

These are views that narrow data for a reader; they are not a security boundary, since whoever can read
the base files can read everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _principal(principal: str | None) -> Column:
    return F.lit(principal) if principal is not None else F.current_user()


def groups_of(memberships: DataFrame, principal: str | None = None, user: str = "user", group: str = "group_name") -> DataFrame:
    return memberships.where(F.col(user) == _principal(principal)).select(F.col(group).alias("_group")).distinct()


def row_filter(df: DataFrame, group: Column, memberships: DataFrame, principal: str | None = None, user: str = "user", group_col: str = "group_name") -> DataFrame:
    """Rows whose derived group, such as concat('ANALYST_', country), contains the reader."""
    g = groups_of(memberships, principal, user, group_col)
    return df.join(g, group == g["_group"], "left_semi")


def membership_flag(df: DataFrame, group: Column, memberships: DataFrame, principal: str | None = None, out: str = "is_member", user: str = "user", group_col: str = "group_name") -> DataFrame:
    g = groups_of(memberships, principal, user, group_col)
    return df.join(g, group == g["_group"], "left").withColumn(out, F.col("_group").isNotNull()).drop("_group")


def own_permissions(permissions: DataFrame, principal: str | None = None, user: str = "analyst_email") -> DataFrame:
    return permissions.where(F.col(user) == _principal(principal))


def permission_filter(df: DataFrame, permissions: DataFrame, on: str, principal: str | None = None, user: str = "analyst_email", value: str = "country_filter", keep: Sequence[str] = ("gdpr_filter",)) -> DataFrame:
    """Rows the reader's permission rows allow, once each, with the permission's flags. Of several permission
    rows for one value the largest flag wins, so a row that one of them masks has no open copy."""
    p = own_permissions(permissions, principal, user).groupBy(F.col(value).alias("_allowed")).agg(*[F.max(k).alias(k) for k in keep])
    return df.join(p, F.col(on) == F.col("_allowed")).drop("_allowed")


def mask(col: str, flag: Column) -> Column:
    return F.when(flag, F.sha1(F.col(col).cast("string"))).otherwise(F.col(col).cast("string")).alias(col)


def secure_view(df: DataFrame, permissions: DataFrame, on: str, open_cols: Sequence[str], pii_cols: Sequence[str], principal: str | None = None, **names) -> DataFrame:
    """Filter by permission and hash the personal columns where the reader's flag is 1; columns in neither
    list are left out."""
    j = permission_filter(df, permissions, on, principal, **names)
    flag = F.coalesce(F.col("gdpr_filter") == 1, F.lit(False))
    return j.select(*open_cols, *[mask(c, flag) for c in pii_cols])
