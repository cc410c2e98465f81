"""Registered queries: a Spark callable and, where SQL can say it, the equivalent DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import load, workdir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def ts_text(c: str | Column) -> Column:
    """Timestamp as text with microseconds; DuckDB: strftime(x, '%Y-%m-%d %H:%M:%S.%f')."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def day_text(c: str | Column) -> Column:
    """Day as text; DuckDB: strftime(x, '%Y-%m-%d')."""
    return F.date_format(c, "yyyy-MM-dd")


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


__all__ = ["QUERIES", "ORACLES", "query", "ts_text", "day_text", "money", "load", "workdir", "F", "W"]
