"""Lineage as edge tables: which dataset or column feeds which."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import count

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize

EDGE_DDL = "source string, target string, at timestamp"


def edges(spark: SparkSession, target: str, sources: Sequence[str]) -> DataFrame:
    """Edges of one write."""
    df = spark.createDataFrame([(s, target) for s in sources], "source string, target string")
    return df.withColumn("at", F.current_timestamp())


def column_edges(target: str, mapping: Mapping[str, Sequence[str]], schemas: Mapping[str, DataFrame]) -> DataFrame:
    """Column edges from a declared map {target column: ["table.column", ...]}, checked against the schemas."""
    rows = []
    for col, sources in mapping.items():
        if col not in schemas[target].columns:
            raise ValueError(f"{target} has no column {col}")
        for s in sources:
            table, name = s.rsplit(".", 1)
            if table not in schemas or name not in schemas[table].columns:
                raise ValueError(f"unknown source column {s}")
            rows.append((table, name, target, col))
    return schemas[target].sparkSession.createDataFrame(rows, "source string, source_column string, target string, target_column string")


def closure(edge: DataFrame, start: DataFrame | Sequence[str], downstream: bool = True, max_depth: int | None = None) -> DataFrame:
    """Every node reachable from ``start`` with its smallest distance; cycles and diamonds are visited once.

    One join per level: the new nodes of a level against the edges, minus the nodes already seen. Each
    level is checkpointed, so the plan does not grow and a lost executor does not restart the walk.
    The walk ends when a level brings nothing new; a ``max_depth`` that is reached before is an error.
    """
    a, b = ("source", "target") if downstream else ("target", "source")
    step = edge.select(F.col(a).alias("node"), F.col(b).alias("next")).where("node is not null and next is not null")
    step = materialize(step.distinct())  # every level joins it
    if not isinstance(start, DataFrame):
        start = edge.sparkSession.createDataFrame([(s,) for s in start], "node string")
    front = start.select("node").distinct().withColumn("depth", F.lit(0))
    seen = front
    for d in count(1):
        nxt = front.join(step, "node").select(F.col("next").alias("node")).distinct()
        front = materialize(nxt.join(seen, "node", "left_anti").withColumn("depth", F.lit(d)))
        if front.isEmpty():
            break
        if max_depth is not None and d > max_depth:
            raise ValueError(f"nodes are more than {max_depth} steps away")
        seen = materialize(seen.unionByName(front)) if d % 16 == 0 else seen.unionByName(front)
    return seen.where("depth > 0")


def redact(nodes: DataFrame, grants: DataFrame, principal: str, name: str = "node", user: str = "user", granted: str = "name") -> DataFrame:
    """Hide the names of nodes the reader may not read; the nodes stay."""
    g = grants.where(F.col(user) == principal).select(F.col(granted).alias("_g")).distinct()
    j = nodes.join(g, F.col(name) == F.col("_g"), "left")
    return j.withColumn(name, F.when(F.col("_g").isNotNull(), F.col(name)).otherwise("REDACTED")).drop("_g")


def recent(edge: DataFrame, as_of: str | None = None, days: int = 30, at: str = "at") -> DataFrame:
    """Edges written in the rolling window that ends at ``as_of`` (default now)."""
    end = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    t = F.col(at).cast("timestamp")
    return edge.where((t > end - F.make_dt_interval(F.lit(days))) & (t <= end))
