"""Out-of-order micro-batches of changes into a type 1 or type 2 dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators import scd
from ..operators.versioned import Commit, VersionedTable

BUCKET = "_bucket"


def _bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    """Join condition on equal keys, NULL keys included."""
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(b[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return cond


class ChangeTarget:
    """Keeps a dimension up to date from micro-batches in any order.

    Type 1 stores the mergeable state of ``scd1_state`` (deletes and column positions included), so late
    rows, late deletes and late NULL updates give the same result as the whole log at once. Type 2 keeps the
    changes themselves and, beside them, the intervals. A batch adds its changes; whenever the log has doubled, and at the end of ``run``, the
    intervals of the keys with new changes are computed anew, so the work over many batches follows the rows, not rows times
    batches. ``read`` computes the keys that have changes since then.
    Batches are told by stream and number; a stream with a new checkpoint reads everything again, and a change that
    comes twice is one change.
    Both are split into buckets of keys, and only buckets that hold a key of the batch are rewritten. The
    batch number is part of every commit, so a batch that comes again after a failure changes nothing.
    Choose ``buckets`` so that one bucket is a few files (thousands for a very large dimension).
    """

    def __init__(self, spark, path: str, keys, sequence_by, schema, delete_when: str | None = None,
                 ignore_null_updates: bool = False, except_cols: Sequence[str] = (), scd_type: int = 1, tie_by=None, buckets: int = 64):
        self.spark, self.table, self.log = spark, VersionedTable(spark, f"{path}/state"), VersionedTable(spark, f"{path}/log")
        self.keys, self.seq = scd._names(keys), scd._names(sequence_by)
        self.schema, self.delete_when, self.ignore_null = schema, delete_when, ignore_null_updates
        self.except_cols, self.scd_type, self.tie_by, self.buckets = list(except_cols), scd_type, tie_by, buckets

    def _stream(self) -> str:
        """The query that a batch number belongs to; a new checkpoint is a new query, whose numbers begin at 0 again."""
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""

    def _has(self, table: VersionedTable, batch_id: int) -> bool:
        if not table.exists():
            return False
        c = table._commit()
        if c.params.get("stream", "") == self._stream() and "batch" in c.params:
            return batch_id <= c.params["batch"]  # numbers of one stream rise
        mine = F.coalesce(F.get_json_object("params", "$.stream"), F.lit("")) == self._stream()
        done = table.history().where(mine).select(F.max(F.get_json_object("params", "$.batch").cast("long"))).first()[0]
        return done is not None and batch_id <= done

    def _params(self, batch_id: int) -> dict:
        return {"batch": batch_id, "stream": self._stream()}

    def _save(self, table: VersionedTable, df: DataFrame, touched: list[int], batch_id: int) -> None:
        params = self._params(batch_id)
        if table.exists():
            table.replace_parts(df, touched, "BATCH", params)
        else:
            VersionedTable.create(df, table.path, partition_by=BUCKET, operation="BATCH", params=params)

    def _scd2(self, changes: DataFrame) -> DataFrame:
        return scd.apply_changes(changes, self.keys, self.seq, self.delete_when, self.ignore_null, self.except_cols, 2, self.tie_by)

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        if self._has(self.log if self.scd_type == 2 else self.table, batch_id):
            return
        batch = _bucket(batch, self.keys, self.buckets).persist()
        try:
            touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            if touched:
                (self._batch2 if self.scd_type == 2 else self._batch1)(batch, touched, batch_id)
        finally:
            batch.unpersist()

    def _batch1(self, batch: DataFrame, touched: list[int], batch_id: int) -> None:
        state = scd.scd1_state(batch.drop(BUCKET), self.keys, self.seq, self.delete_when, self.ignore_null, self.tie_by)
        if self.table.exists():
            old = self.table.read().where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            state = scd.scd1_merge(old, state, self.keys)
        self._save(self.table, _bucket(state, self.keys, self.buckets), touched, batch_id)

    def _batch2(self, batch: DataFrame, touched: list[int], batch_id: int) -> None:
        if self.log.exists():
            self.log.append(batch, operation="BATCH", params=self._params(batch_id))
        else:
            VersionedTable.create(batch, self.log.path, partition_by=BUCKET, operation="BATCH", params=self._params(batch_id))
        log = self.log._commit()
        if log.n_rows >= 2 * self._folded().get("log_rows", 0):
            self._fold(log)

    def _folded(self) -> dict:
        """Up to which version of the log, of how many rows, the intervals go."""
        return self.table._commit().params if self.table.exists() else {}

    def _fresh(self, log: Commit) -> tuple[list[int], DataFrame, DataFrame] | None:
        """(buckets, keys, intervals of these) of the changes that the intervals do not hold yet."""
        upto = self._folded().get("log_version")
        done = set() if upto is None else {p[:3] for p in self.log._commit(upto).parts}
        new = [p for p in log.parts if p[:3] not in done]
        if not new:
            return None
        touched = {p[2] for p in new}
        keys = self.log._rows(log, new).select(*[F.col(k).alias(f"_k_{k}") for k in self.keys]).distinct()
        rows = self.log._rows(log, [p for p in log.parts if p[2] in touched])
        return [int(t.split("=", 1)[1]) for t in touched], keys, self._scd2(rows.join(keys, _same(rows, keys, self.keys), "left_semi").drop(BUCKET))

    def _fold(self, log: Commit) -> None:
        if got := self._fresh(log):
            touched, keys, fresh = got
            params = {"log_version": log.version, "log_rows": log.n_rows}
            if not self.table.exists():
                VersionedTable.create(_bucket(fresh, self.keys, self.buckets), self.table.path, partition_by=BUCKET, operation="BATCH", params=params)
                return
            old = self.table.read().where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            fresh = old.join(keys, _same(old, keys, self.keys), "left_anti").unionByName(fresh)
            self.table.replace_parts(_bucket(fresh, self.keys, self.buckets), touched, "BATCH", params)

    def _intervals(self) -> DataFrame:
        got = self._fresh(self.log._commit())
        if got is None:
            return self.table.read().drop(BUCKET)
        if not self.table.exists():
            return got[2]
        old = self.table.read().drop(BUCKET)
        return old.join(got[1], _same(old, got[1], self.keys), "left_anti").unionByName(got[2])

    def run(self, sdf: DataFrame, checkpoint: str):
        """Apply everything available in the stream and stop."""
        q = sdf.writeStream.foreachBatch(self.apply_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        if self.scd_type == 2 and self.log.exists():
            self._fold(self.log._commit())
        return q

    def read(self) -> DataFrame:
        """The dimension as it stands."""
        empty = self.spark.createDataFrame([], self.schema)
        if not (self.log if self.scd_type == 2 else self.table).exists():
            return scd.apply_changes(empty, self.keys, self.seq, self.delete_when, self.ignore_null, self.except_cols, self.scd_type, self.tie_by)
        if self.scd_type == 2:
            return self._intervals()
        state = self.table.read().drop(BUCKET)
        return scd.scd1_view(state, [c for c in empty.columns if c not in self.except_cols])
