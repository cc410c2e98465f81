"""Declared datasets that feed each other: streaming tables, live tables and change targets.

    flow = Flow(spark, "/shared/shop")

    @flow.stream(expect={"five letters": "length(store_id) = 5"})
    def sales_clean():
        return flow.read_stream("sales_raw").selectExpr("id", "ts", "store_id")

    @flow.table(comment="sales per store")
    def store_sales():
        return flow.read("sales_clean").groupBy("store_id").count()

    flow.update()

A dataset is a function that returns a DataFrame. Reading another dataset brings that one up to date
first and records the edge, so the order follows from the reads.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import quality
from ..operators.versioned import VersionedTable
from ..session import materialize
from .changes import ChangeTarget

EVENT_DDL = "id string, timestamp timestamp, event_type string, flow string, details string"


@dataclass
class Dataset:
    name: str
    kind: str  # "table" (recomputed), "stream" (append only) or "changes"
    fn: Callable[[], DataFrame]
    comment: str = ""
    properties: dict = field(default_factory=dict)
    expect: dict = field(default_factory=dict)
    expect_or_drop: dict = field(default_factory=dict)
    expect_or_fail: dict = field(default_factory=dict)
    options: dict = field(default_factory=dict)

    @property
    def rules(self) -> dict:
        return {**self.expect, **self.expect_or_drop}


class _Watch(StreamingQueryListener):
    """Adds up what the micro-batches of a flow's streams report, however many they are."""

    def __init__(self, flow: "Flow"):
        self.flow = flow

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.flow._report(str(event.progress.runId), event.progress)

    def onQueryTerminated(self, event) -> None:
        self.flow._run(str(event.runId))["over"].set()


class Flow:
    """``patience``: seconds to wait for a stream's last reports after its end. A ``flow_progress`` event says whether all of them
    came (``complete``); where they did not, its counts are lower bounds."""

    def __init__(self, spark: SparkSession, root: str, config: Mapping[str, str] | None = None, patience: float = 600):
        self.spark, self.root, self.config = spark, root.rstrip("/"), dict(config or {})
        self.datasets: dict[str, Dataset] = {}
        self.queries: list = []
        self._done: dict[str, object] = {}
        self._stack: list[str] = []
        self._edges: set[tuple[str, str]] = set()
        self._targets: dict[str, ChangeTarget] = {}
        self._continuous: str | None = None
        self._generation = self._event_count("full_refresh")
        self._watch: _Watch | None = None
        self._runs: dict[str, dict] = {}
        self._lock = threading.Lock()
        self.patience = patience

    # --- declarations -------------------------------------------------------------------------------

    def _register(self, kind: str, name: str | None, **kw):
        def deco(fn):
            n = name or fn.__name__
            if n in self.datasets:
                raise ValueError(f"dataset declared twice: {n}")
            self.datasets[n] = Dataset(n, kind, fn, **{k: v or ("" if k == "comment" else {}) for k, v in kw.items()})
            return fn

        return deco

    def table(self, name=None, comment="", properties=None, expect=None, expect_or_drop=None, expect_or_fail=None):
        """A table recomputed from its inputs at every update."""
        return self._register("table", name, comment=comment, properties=properties, expect=expect, expect_or_drop=expect_or_drop, expect_or_fail=expect_or_fail)

    def stream(self, name=None, comment="", properties=None, expect=None, expect_or_drop=None, expect_or_fail=None):
        """An append-only table fed by new rows only; the function returns a streaming DataFrame."""
        return self._register("stream", name, comment=comment, properties=properties, expect=expect, expect_or_drop=expect_or_drop, expect_or_fail=expect_or_fail)

    def apply_changes(self, target: str, source: str, keys, sequence_by, **options) -> None:
        """Keep ``target`` as a type 1 or 2 dimension of the streaming dataset ``source``."""
        self._register("changes", target, options={"keys": keys, "sequence_by": sequence_by, **options})(lambda: self.read_stream(source))

    # --- reads --------------------------------------------------------------------------------------

    def _use(self, name: str) -> None:
        if self._stack:
            self._edges.add((name, self._stack[-1]))
        self._refresh(name)

    def read(self, name: str) -> DataFrame:
        """All rows of a dataset."""
        if self._stack:
            self._use(name)
        kind = self.datasets[name].kind
        if kind == "table":
            return VersionedTable(self.spark, self._path(name)).read()
        if kind == "changes":
            return self._targets[name].read()
        r = self.spark.read.schema(self._done[name]) if name in self._done else self.spark.read
        return r.parquet(self._path(name))

    def read_stream(self, name: str) -> DataFrame:
        """The rows of a streaming dataset that the reader has not seen yet."""
        if self.datasets[name].kind != "stream":
            raise ValueError(f"{name} is not append-only; read it with read()")
        self._use(name)
        return self.spark.readStream.schema(self._done[name]).parquet(self._path(name))

    # --- updates ------------------------------------------------------------------------------------

    def update(self, full_refresh: bool = False, continuous: str | None = None) -> None:
        """Bring every dataset up to date.

        ``full_refresh`` starts all datasets anew and replays their inputs. ``continuous`` (an interval)
        leaves the streams running in ``queries``; the default handles what is available and stops.
        """
        if full_refresh:
            self._event("user_action", None, {"action": "full_refresh"})
        self._generation = self._event_count("full_refresh")
        if self._watch is None:
            self._watch = _Watch(self)
            self.spark.streams.addListener(self._watch)
        self._done, self._edges, self._targets, self._continuous, self.queries = {}, set(), {}, continuous, []
        for name in self.datasets:
            self._refresh(name)
        for target in self.datasets:
            sources = sorted(s for s, t in self._edges if t == target)
            self._event("flow_definition", target, {"flow_definition": {"output_dataset": target, "input_datasets": sources, "flow_type": self.datasets[target].kind}})

    def stop(self) -> None:
        for q in self.queries:
            q.stop()
            run = self._run(str(q.runId))
            if not self._all_reported(run):  # what came is in the log already
                self._progress(run["dataset"], 0, [], complete=False)
        if self._watch is not None:
            self.spark.streams.removeListener(self._watch)
            self._watch = None

    def catch_up(self) -> None:
        """For a continuous run: wait until the streams have taken what has arrived, then compute the live tables anew."""
        for q in self.queries:
            q.processAllAvailable()
        for name, d in self.datasets.items():
            if d.kind == "table":
                self._done.pop(name, None)
        for name in self.datasets:
            self._refresh(name)

    def _refresh(self, name: str) -> None:
        if name in self._done:
            return
        if name in self._stack:
            raise ValueError("datasets read each other: " + " -> ".join([*self._stack, name]))
        d = self.datasets[name]
        self._stack.append(name)
        try:
            df = d.fn()
            getattr(self, f"_run_{d.kind}")(d, df)
        finally:
            self._stack.pop()

    def _path(self, name: str) -> str:
        return f"{self.root}/tables/g{self._generation}/{name}"

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/g{self._generation}/{name}"

    def _enforce(self, d: Dataset, df: DataFrame) -> DataFrame:
        if d.expect_or_drop:
            df = quality.drop_violations(df, d.expect_or_drop)
        if d.expect_or_fail:
            df = quality.fail_on_violation(df, d.expect_or_fail)
        return df

    def _run_table(self, d: Dataset, df: DataFrame) -> None:
        """Counts are taken from stored rows, so the query runs once and retries do not distort them: from the
        table itself, or where rows are dropped from a checkpoint of all rows."""
        if d.expect_or_drop:
            df = materialize(df)
        out = self._enforce(d, df)
        t = VersionedTable(self.spark, self._path(d.name))
        if t.exists():
            t.commit(out, "REFRESH", overwrite_schema=True)
        else:
            VersionedTable.create(out, t.path, operation="REFRESH")
        self._done[d.name] = df.schema
        seen = []
        if d.rules:
            rows = df if d.expect_or_drop else t.read()
            seen = [rows.agg(*quality.counters(d.rules, list(d.expect_or_drop))).first().asDict()]
        self._progress(d, t._commit().n_rows, seen)

    def _run_stream(self, d: Dataset, df: DataFrame) -> None:
        if not df.isStreaming:
            raise ValueError(f"{d.name}: a streaming dataset must return a streaming DataFrame")
        path, name = self._path(d.name), f"rules_{d.name}"
        self.spark.createDataFrame([], df.schema).write.mode("ignore").parquet(path)  # readable before the first row
        counted = quality.observe(df, name, d.rules, list(d.expect_or_drop))
        w = self._enforce(d, counted).writeStream.format("parquet").option("checkpointLocation", self._checkpoint(d.name))
        self._start(w, d, lambda w: w.start(path), df, name)

    def _run_changes(self, d: Dataset, df: DataFrame) -> None:
        o = dict(d.options)
        t = ChangeTarget(self.spark, self._path(d.name), o.pop("keys"), o.pop("sequence_by"), df.schema, **o)
        self._targets[d.name] = t
        w = df.writeStream.foreachBatch(t.apply_batch).option("checkpointLocation", self._checkpoint(d.name))
        self._start(w, d, lambda w: w.start(), df, None)

    def _start(self, w, d: Dataset, start, df: DataFrame, observed: str | None) -> None:
        w = w.trigger(processingTime=self._continuous) if self._continuous else w.trigger(availableNow=True)
        q = start(w)
        self._done[d.name] = df.schema
        run = self._run(str(q.runId))
        with self._lock:
            run |= {"dataset": d, "observed": observed, "log": bool(self._continuous)}
            early, run["waiting"] = run["waiting"], []
        for p in early:
            self._report(str(q.runId), p)
        if self._continuous:
            self.queries.append(q)
            return
        q.awaitTermination()
        complete = self._all_reported(run)
        with self._lock:
            rows, seen = run["rows"], run["seen"]
        self._progress(d, rows, seen, complete)

    def _all_reported(self, run: dict) -> bool:
        """Reports come in order and the end of the query last; a number left out among the micro-batches is one that got lost."""
        over = run["over"].wait(self.patience)
        with self._lock:
            ids = run["batches"]
            return over and (not ids or len(ids) == max(ids) - min(ids) + 1)

    def _run(self, run_id: str) -> dict:
        with self._lock:
            return self._runs.setdefault(run_id, {"dataset": None, "observed": None, "log": False, "rows": 0, "seen": [], "waiting": [], "batches": set(), "over": threading.Event()})

    def _report(self, run_id: str, p) -> None:
        """One micro-batch: added to its run, and in a continuous run written to the event log."""
        run = self._run(run_id)
        with self._lock:
            if run["dataset"] is None:
                run["waiting"].append(p)
                return
            run["batches"].add(p.batchId)
        name = run["observed"]
        seen = [p.observedMetrics[name].asDict()] if name and name in (p.observedMetrics or {}) else []
        rows = sum(m["rows"] - m["dropped"] for m in seen) if name else p.numInputRows
        if run["log"]:
            if p.numInputRows:
                self._progress(run["dataset"], rows, seen)
            return
        with self._lock:
            run["rows"] += rows
            # counts only add up, so one dictionary stands for all micro-batches
            run["seen"] = [{k: sum(m[k] for m in run["seen"] + seen) for k in seen[0]}] if seen else run["seen"]

    # --- event log ----------------------------------------------------------------------------------

    def _progress(self, d: Dataset, rows: int, seen: list[dict], complete: bool = True) -> None:
        details: dict = {"metrics": {"num_output_rows": rows}, "complete": complete}
        if d.rules:
            total = sum(m["rows"] for m in seen)
            exp = []
            for i, name in enumerate(d.rules):
                failed = sum(m[f"failed_{i}"] for m in seen)
                exp.append({"name": name, "dataset": d.name, "passed_records": total - failed, "failed_records": failed})
            details["data_quality"] = {"dropped_records": sum(m["dropped"] for m in seen), "expectations": exp}
        self._event("flow_progress", d.name, {"flow_progress": details})

    def _event(self, kind: str, flow: str | None, details: dict) -> None:
        row = (uuid.uuid4().hex, datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), kind, flow, json.dumps(details))
        df = self.spark.createDataFrame([row], EVENT_DDL.replace("timestamp timestamp", "timestamp string"))
        df.coalesce(1).write.mode("append").json(f"{self.root}/events")

    def event_log(self) -> DataFrame:
        try:
            return self.spark.read.schema(EVENT_DDL).json(f"{self.root}/events")
        except AnalysisException:
            return self.spark.createDataFrame([], EVENT_DDL)

    def _event_count(self, action: str) -> int:
        return self.event_log().where(F.get_json_object("details", "$.action") == action).count()

    def edges(self) -> DataFrame:
        """Table lineage (source, target, at) of all updates."""
        e = self.event_log().where("event_type = 'flow_definition'")
        src = F.from_json(F.get_json_object("details", "$.flow_definition.input_datasets"), "array<string>")
        return e.select(F.explode(src).alias("source"), F.col("flow").alias("target"), F.col("timestamp").alias("at"))
