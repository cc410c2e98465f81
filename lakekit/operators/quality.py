"""Data-quality expectations, their metrics, quarantine and alerts.

An expectation is a name and a condition. A row violates it when the condition is false or NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

Rules = Mapping[str, str | Column]


def holds(rule: str | Column) -> Column:
    return F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False))


def all_hold(rules: Rules) -> Column:
    out = F.lit(True)
    for r in rules.values():
        out = out & holds(r)
    return out


def counters(rules: Rules, drop: Sequence[str] = ()) -> list[Column]:
    """Aggregates: rows, violations of every rule, rows that violate a rule in ``drop``."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(~holds(r)).alias(f"failed_{i}") for i, r in enumerate(rules.values())]
    return [*aggs, F.count_if(~all_hold({k: rules[k] for k in drop})).alias("dropped")]


def observe(df: DataFrame, name: str, rules: Rules, drop: Sequence[str] = ()) -> DataFrame:
    """Count passes and violations of a stream while its rows flow by; no second pass.

    The counts arrive with the progress of the query under ``name``. A task that has to be run again may be
    counted again, so use ``metrics`` on stored rows where exact numbers matter.
    """
    return df.observe(name, *counters(rules, drop))


def metrics(df: DataFrame, dataset: str, rules: Rules) -> DataFrame:
    """One row per expectation: dataset, name, passed_records, failed_records. One pass over the data."""
    names = list(rules)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.count_if(~holds(rules[k])).alias(f"f{i}") for i, k in enumerate(names)]
    items = [F.struct(F.lit(k).alias("name"), F.col(f"f{i}").alias("failed")) for i, k in enumerate(names)]
    one = df.agg(*aggs).select("n", F.explode(F.array(*items)).alias("x"))
    return one.select(
        F.lit(dataset).alias("dataset"), F.col("x.name").alias("name"),
        (F.col("n") - F.col("x.failed")).alias("passed_records"), F.col("x.failed").alias("failed_records"),
    )


def drop_violations(df: DataFrame, rules: Rules) -> DataFrame:
    """Only the rows that meet every expectation."""
    return df.where(all_hold(rules))


def fail_on_violation(df: DataFrame, rules: Rules) -> DataFrame:
    """Any violating row fails the job that reads the result, so nothing is committed."""
    for name, r in rules.items():
        df = df.where(F.when(holds(r), True).otherwise(F.raise_error(F.lit(f"expectation failed: {name}")).cast("boolean")))
    return df


def failed_rules(rules: Rules) -> Column:
    """Names of the violated expectations of a row."""
    return F.array_compact(F.array(*[F.when(~holds(r), F.lit(k)) for k, r in rules.items()]))


def quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(good rows, violating rows with ``failed_rules``)."""
    tagged = df.withColumn("failed_rules", failed_rules(rules))
    return tagged.where(F.size("failed_rules") == 0).drop("failed_rules"), tagged.where(F.size("failed_rules") > 0)


# --- event log --------------------------------------------------------------------------------------

EXPECTATIONS_DDL = "array<struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>>"


def progress_event(m: DataFrame, rows: Column, dropped: Column, flow: str, event_id: str) -> DataFrame:
    """One event-log row with the metrics of one flow update as nested JSON ``details``."""
    exp = F.collect_list(F.struct("name", "dataset", "passed_records", "failed_records"))
    one = m.agg(F.sort_array(exp).alias("e"), rows.alias("r"), dropped.alias("d"))
    details = F.struct(
        F.struct(
            F.struct(F.col("r").alias("num_output_rows")).alias("metrics"),
            F.struct(F.col("d").alias("dropped_records"), F.col("e").alias("expectations")).alias("data_quality"),
        ).alias("flow_progress")
    )
    return one.select(
        F.lit(event_id).alias("id"), F.current_timestamp().alias("timestamp"), F.lit("flow_progress").alias("event_type"),
        F.lit(flow).alias("flow"), F.to_json(details).alias("details"),
    )


def event_metrics(log: DataFrame) -> DataFrame:
    """Expectation results found in an event log: id, dataset, name, failed_records, passed_records."""
    path = "$.flow_progress."
    e = F.from_json(F.get_json_object("details", path + "data_quality.expectations"), EXPECTATIONS_DDL)
    q = log.where(F.get_json_object("details", path + "metrics").isNotNull()).select("id", F.explode(e).alias("e"))
    return q.select("id", "e.dataset", "e.name", "e.failed_records", "e.passed_records")


# --- alerts and checks ------------------------------------------------------------------------------

_OPS = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "==": "__eq__", "!=": "__ne__"}


def breaching(df: DataFrame, column: str, op: str, threshold) -> DataFrame:
    """Rows of a query result that breach the threshold."""
    return df.where(getattr(F.col(column), _OPS[op])(F.lit(threshold)))


def evaluate_alert(df: DataFrame, column: str, op: str, threshold) -> tuple[str, DataFrame]:
    """("TRIGGERED" or "OK", the breaching rows)."""
    rows = breaching(df, column, op, threshold)
    return ("OK" if rows.isEmpty() else "TRIGGERED"), rows


def share_check(df: DataFrame, split_col: str, expected: Mapping[str, float], tolerance: float = 0.01) -> DataFrame:
    """Share of every split with its expected value and whether it lies within the tolerance."""
    n = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))  # one row per split
    want = F.element_at(F.create_map(*[F.lit(x) for kv in expected.items() for x in kv]), F.col(split_col))
    out = n.withColumns({"share": F.col("n") / total.cast("double"), "expected": want})
    return out.withColumn("within", F.abs(F.col("share") - F.col("expected")) <= tolerance)
