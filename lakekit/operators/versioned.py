"""A dataset with versions: parquet folders plus one small commit record per version.

Every commit writes its new rows to a folder of its own, ``data/_write=<id>`` (below it one folder per
partition value), and then one record that lists the *parts* the version consists of. A part is one such
folder. Appends add a part; update, delete and merge rewrite only the parts that hold a touched row and keep
the other folders, so the cost follows the touched partitions, not the table. Readers only see versions with
a record; a failed commit leaves an unlisted folder and nothing else, and a refused one removes its folder. A
writer that finds the record of its version present fails, but the check and the write are two steps: one writer at
a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import materialize
from . import changes as C

COMMIT_DDL = (
    "version long, timestamp timestamp, operation string, params string, n_rows long, columns string, "
    "parts array<struct<base:string,write:string,value:string,n_rows:long>>, settings string"
)


@dataclass
class Commit:
    version: int
    timestamp: datetime
    operation: str
    params: dict
    n_rows: int
    columns: list[dict]  # name, physical, type (json), comment
    parts: list[tuple[str, str, str | None, int]]  # table path ("" = own), write id, partition folder, rows
    settings: dict = field(default_factory=dict)  # key, partition_by, constraints, change_feed_from

    def schema(self, names: str = "name") -> T.StructType:
        out = []
        for c in self.columns:
            meta = {"comment": c["comment"]} if c.get("comment") else {}
            out.append(T.StructField(c[names], T._parse_datatype_json_string(c["type"]), True, meta))
        return T.StructType(out)


class VersionedTable:
    """Read and change a versioned dataset at ``path``; see the module text for the layout."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- creation -----------------------------------------------------------------------------------

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str | Sequence[str] | None = None, partition_by: str | None = None, change_feed: bool = False, operation: str = "CREATE", params: Mapping | None = None) -> "VersionedTable":
        """Version 0 from a DataFrame. ``key`` names the unique key; ``partition_by`` one column to split parts by."""
        t = cls(df.sparkSession, path)
        if t.exists():
            raise ValueError(f"{path} already holds a versioned table")
        key = [key] if isinstance(key, str) else list(key) if key else None
        settings = {"key": key, "partition_by": partition_by, "constraints": {}, "change_feed_from": 0 if change_feed else None}
        base = Commit(-1, None, "", {}, 0, _columns(df), [], settings)
        t._write(base, df, [], operation, dict(params or {}))
        return t

    def exists(self) -> bool:
        try:
            return not self._log().isEmpty()
        except AnalysisException:
            return False

    # --- commit log ---------------------------------------------------------------------------------

    def _log(self) -> DataFrame:
        return self.spark.read.schema(COMMIT_DDL + ", _v long").json(f"{self.path}/commits")

    def _commit(self, version: int | None = None, timestamp: str | datetime | None = None) -> Commit:
        log = self._log()
        if version is None and timestamp is None:
            # records list all parts: of many versions only the newest is read, by the number in its folder's name
            files = log.inputFiles()
            newest = max((int(f.rsplit("/_v=", 1)[1].split("/")[0]) for f in files), default=None)
            log = log.where(F.col("_v") == newest) if newest is not None else log
        if version is not None:
            log = log.where(F.col("_v") == version)
        if timestamp is not None:
            log = log.where(F.col("timestamp") <= F.lit(timestamp).cast("timestamp"))
        row = log.orderBy(F.desc("version")).first()
        if row is None:
            raise ValueError(f"no version of {self.path} at version={version} timestamp={timestamp}")
        return Commit(
            row.version, row.timestamp, row.operation, json.loads(row.params), row.n_rows, json.loads(row.columns),
            [(p.base, p.write, p.value, p.n_rows) for p in row.parts], json.loads(row.settings),
        )

    def _record(self, c: Commit) -> int:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        row = (c.version, now, c.operation, json.dumps(c.params), c.n_rows, json.dumps(c.columns), c.parts, json.dumps(c.settings))
        ddl = COMMIT_DDL.replace("timestamp timestamp", "timestamp string")
        df = self.spark.createDataFrame([row], ddl).coalesce(1)
        df.write.mode("error").json(f"{self.path}/commits/_v={c.version}")
        return c.version

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        return self._log().select("version", "timestamp", "operation", "params", "n_rows").orderBy(F.desc("version"))

    @property
    def version(self) -> int:
        return self._commit().version

    # --- reading ------------------------------------------------------------------------------------

    def read(self, version: int | None = None, timestamp: str | datetime | None = None) -> DataFrame:
        """The latest rows, or those as of a version or a time."""
        c = self._commit(version, timestamp)
        return self._rows(c, c.parts)

    def _rows(self, c: Commit, parts, names: str = "name", with_part: bool = False) -> DataFrame:
        pcol = c.settings.get("partition_by")
        physical = c.schema("physical")
        cols = [F.col(x["physical"]).alias(x[names], metadata={"comment": x["comment"]}) if x.get("comment") and names == "name" else F.col(x["physical"]).alias(x[names]) for x in c.columns]
        out = None
        for base in sorted({p[0] for p in parts}):
            root = self.path if base == "" else base
            paths = [self._folder(root, p, pcol) for p in parts if p[0] == base]
            schema = T.StructType([*physical.fields, T.StructField("_write", T.StringType())])
            df = self.spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths)
            if with_part:
                value = F.col(pcol).cast("string") if pcol else F.lit(None).cast("string")
                df = df.withColumn("_part", F.struct(F.lit(base).alias("base"), F.col("_write").alias("write"), value.alias("value")))
            if pcol:
                df = _decoded(df, pcol)
            df = df.select(*cols, *(["_part"] if with_part else []))
            out = df if out is None else out.unionByName(df)
        if out is None:
            out = self.spark.createDataFrame([], c.schema(names))
            if with_part:
                out = out.withColumn("_part", F.lit(None).cast("struct<base:string,write:string,value:string>"))
        return out

    @staticmethod
    def _folder(root: str, part, pcol: str | None) -> str:
        base = f"{root}/data/_write={part[1]}"
        return f"{base}/{part[2]}" if pcol else base

    # --- writing ------------------------------------------------------------------------------------

    def _write(self, base: Commit, df: DataFrame, keep, operation: str, params: dict, columns=None) -> int:
        """Write ``df`` (logical names) as the new part(s), check the constraints, record the version."""
        n = base.version + 1
        columns = columns or base.columns
        c = Commit(n, None, operation, params, 0, columns, list(keep), dict(base.settings))
        pcol = c.settings.get("partition_by")
        write = f"{n}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.path}/data/_write={write}"
        phys = C.conform(df, c.schema()).select(*[F.col(x["name"]).alias(x["physical"]) for x in columns])
        if pcol:
            phys = _encoded(phys, pcol)
            # rows of one partition value are spread over several tasks when AQE finds the value too large
            phys.hint("rebalance", pcol).write.partitionBy(pcol).parquet(folder)
        else:
            phys.write.parquet(folder)
        new = [("", write, v, 0) for v in self._values(folder, pcol)] if pcol else [("", write, None, 0)]
        bad = {k: F.count_if(~C._holds(e)).alias(k) for k, e in c.settings["constraints"].items()}
        # counted on the written files: exact also when tasks were retried, and mostly answered from footers
        got = self._rows(c, new, with_part=True).groupBy("_part.value").agg(F.count(F.lit(1)).alias("_n"), *bad.values()).collect()
        failed = {k: n_bad for k in bad if (n_bad := sum(r[k] for r in got))}
        if failed:
            _remove(self.spark, folder)
            raise ValueError(f"constraint violated (rows): {failed}")
        rows = {r.value: r._n for r in got}
        c.parts += [(*p[:3], rows[_folder_value(p[2])]) for p in new if rows.get(_folder_value(p[2]))]
        c.n_rows = sum(p[3] for p in c.parts)
        return self._record(c)

    def _values(self, folder: str, pcol: str) -> list[str]:
        """Names of the partition folders just written; one row per folder reaches the driver."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
        name = F.element_at(F.split("path", "/"), -2)
        return sorted(r[0] for r in files.select(name).distinct().collect())

    def commit(self, df: DataFrame, operation: str = "WRITE", params: Mapping | None = None, overwrite_schema: bool = False) -> int:
        """Replace the whole content, and with ``overwrite_schema`` the columns too."""
        columns = _columns(df) if overwrite_schema else None
        return self._write(self._commit(), df, [], operation, dict(params or {}), columns)

    def append(self, rows: DataFrame, cols: Sequence[str] | None = None, operation: str = "APPEND", params: Mapping | None = None, merge_schema: bool = False) -> int:
        """Add rows as new part(s); old folders are not touched. ``merge_schema`` adds unknown columns."""
        c = self._commit()
        if cols is not None:
            rows = rows.toDF(*cols)
        columns = list(c.columns)
        if merge_schema:
            names = {x["name"] for x in columns}
            columns += [{**x, "physical": self._physical(c, x["name"])} for x in _columns(rows) if x["name"] not in names]
        return self._write(c, rows, c.parts, operation, dict(params or {}), columns)

    def _touched(self, c: Commit, hits: DataFrame) -> list:
        """Parts that hold one of the rows ``hits`` (with ``_part``): at most one row per part."""
        got = {(r.base, r.write, r.value) for r in hits.select("_part.*").distinct().collect()}
        return [p for p in c.parts if (p[0], p[1], _folder_value(p[2])) in got]

    def _rewrite(self, c: Commit, hits: DataFrame, change, operation: str, params: dict, extra: DataFrame | None = None) -> int:
        touched = self._touched(c, hits)
        df = change(self._rows(c, touched))
        if extra is not None:
            df = df.unionByName(extra)
        return self._write(c, df, [p for p in c.parts if p not in touched], operation, params)

    def update(self, set: Mapping[str, str | Column], where: str | Column | None = None) -> int:
        c = self._commit()
        rows = self._rows(c, c.parts, with_part=True)
        hits = rows.where(C._holds(where)) if where is not None else rows
        return self._rewrite(c, hits, lambda d: C.update(d, set, where), "UPDATE", {"where": str(where), "set": {k: str(v) for k, v in set.items()}})

    def delete(self, where: str | Column | None = None) -> int:
        c = self._commit()
        if where is None:
            return self._write(c, self._rows(c, []), [], "DELETE", {})
        hits = self._rows(c, c.parts, with_part=True).where(C._holds(where))
        return self._rewrite(c, hits, lambda d: C.delete(d, where), "DELETE", {"where": str(where)})

    def merge(self, source: DataFrame, on: str | Sequence[str], matched="update_all", not_matched: str | None = "insert_all") -> int:
        on = [on] if isinstance(on, str) else list(on)
        c = self._commit()
        source = materialize(source)  # looked at several times below: computed once, and the same each time
        target = self._rows(c, c.parts, with_part=True)
        if matched is not None and not C.ambiguous_keys(target, source, on).isEmpty():
            raise ValueError("a target row matches more than one source row")
        hits = target.join(source.select(*on), on, "left_semi")
        if matched is None:
            hits = hits.where(F.lit(False))
        new = C.merge_inserts(target.drop("_part"), source, on) if not_matched else None
        return self._rewrite(c, hits, lambda d: C.merge_updates(d, source, on, matched), "MERGE", {"on": on, "matched": str(matched), "not_matched": str(not_matched)}, new)

    def replace_parts(self, df: DataFrame, values: Sequence, operation: str = "REPLACE", params: Mapping | None = None) -> int:
        """Replace the content of the given partition values by ``df``."""
        c = self._commit()
        text = any(x["physical"] == c.settings.get("partition_by") and x["type"] == '"string"' for x in c.columns)
        gone = {None if v is None else _code(str(v)) if text else str(v) for v in values}
        keep = [p for p in c.parts if _folder_value(p[2]) not in gone]
        return self._write(c, df, keep, operation, dict(params or {}))

    # --- changes to the description only: no data is written ----------------------------------------

    def _meta(self, operation: str, params: dict, columns=None, settings: dict | None = None) -> int:
        c = self._commit()
        return self._record(Commit(c.version + 1, None, operation, params, c.n_rows, columns or c.columns, c.parts, {**c.settings, **(settings or {})}))

    @staticmethod
    def _physical(c: Commit, name: str) -> str:
        taken = {x["physical"] for x in c.columns}
        while name in taken:
            name += "_"
        return name

    def add_column(self, name: str, type_: str) -> int:
        c = self._commit()
        if name in c.schema().fieldNames():
            raise ValueError(f"column exists: {name}")
        dt = T._parse_datatype_string(type_)
        return self._meta("ADD COLUMN", {"column": name}, [*c.columns, {"name": name, "physical": self._physical(c, name), "type": dt.json(), "comment": None}])

    def rename_column(self, old: str, new: str) -> int:
        """Stored files keep their column names; earlier versions keep the old name."""
        c = self._commit()
        names = c.schema().fieldNames()
        if old not in names or new in names:
            raise ValueError(f"cannot rename {old} to {new}")
        s = c.settings
        key = [new if k == old else k for k in s["key"]] if s.get("key") else None
        return self._meta("RENAME COLUMN", {"from": old, "to": new}, [{**x, "name": new} if x["name"] == old else x for x in c.columns], {"key": key})

    def comment_column(self, name: str, comment: str) -> int:
        c = self._commit()
        return self._meta("COMMENT", {"column": name}, [{**x, "comment": comment} if x["name"] == name else x for x in c.columns])

    def add_constraint(self, name: str, expr: str) -> int:
        """Reject later commits with rows where ``expr`` is not true; the present rows must satisfy it too."""
        c = self._commit()
        if not self._rows(c, c.parts).where(~C._holds(expr)).isEmpty():
            raise ValueError(f"existing rows violate {name}")
        return self._meta("ADD CONSTRAINT", {"name": name, "expr": expr}, settings={"constraints": {**c.settings["constraints"], name: expr}})

    def not_null(self, column: str) -> int:
        return self.add_constraint(f"{column} is not null", f"`{column}` is not null")

    def enable_change_feed(self) -> int:
        c = self._commit()
        return self._meta("ENABLE CHANGE FEED", {}, settings={"change_feed_from": c.version + 1})

    # --- change feed --------------------------------------------------------------------------------

    def changes(self, start: int | None = None, end: int | None = None, start_ts=None, end_ts=None) -> DataFrame:
        """Row changes of the versions start..end (inclusive; end open = latest) with ``_change_type``,
        ``_commit_version`` and ``_commit_timestamp``. Only folders that differ between neighbouring
        versions are read; an append is read without any join."""
        log = {r.version: r for r in self._log().select("version", "timestamp").collect()}
        if start_ts is not None:
            cand = [v for v in log if log[v].timestamp >= _ts(self.spark, start_ts)]
            if not cand:
                raise ValueError("no commit at or after start")
            start = min(cand)
        if end_ts is not None:
            end = max((v for v in log if log[v].timestamp <= _ts(self.spark, end_ts)), default=-1)
        end = max(log) if end is None else end
        last = self._commit(end if end >= 0 else 0)
        since = last.settings.get("change_feed_from")
        if since is None or start < since:
            raise ValueError(f"the change feed is recorded from version {since}")
        names = [x["name"] for x in last.columns]
        out = None
        for v in range(start, end + 1):
            step = self._step(v, last)
            if step is not None:
                step = step.withColumns({"_commit_version": F.lit(v).cast("long"), "_commit_timestamp": F.lit(log[v].timestamp)})
                out = step if out is None else out.unionByName(step)
        if out is None:
            empty = self._rows(last, [])
            out = empty.withColumns({"_change_type": F.lit("").cast("string"), "_commit_version": F.lit(0).cast("long"), "_commit_timestamp": F.lit(None).cast("timestamp")})
        return out.select(*names, "_change_type", "_commit_version", "_commit_timestamp")

    def _step(self, v: int, last: Commit) -> DataFrame | None:
        new = self._commit(v)
        old = self._commit(v - 1) if v > 0 else Commit(-1, None, "", {}, 0, new.columns, [], new.settings)
        gone = [p for p in old.parts if p not in new.parts]
        come = [p for p in new.parts if p not in old.parts]
        if not gone and not come:
            return None
        view = Commit(v, None, "", {}, 0, last.columns, [], last.settings)  # rows under the names of the last version
        if not gone:
            return self._rows(view, come).withColumn("_change_type", F.lit("insert"))
        return C.diff(self._rows(view, gone), self._rows(view, come), last.settings.get("key"))

    def version_anti_join(self, v_old: int, on: str | Sequence[str]) -> DataFrame:
        return C.version_anti_join(self.read(), self.read(v_old), on)

    # --- clones and description ---------------------------------------------------------------------

    def clone(self, path: str, version: int | None = None, timestamp=None, deep: bool = True) -> "VersionedTable":
        """A deep clone copies the rows; a shallow one refers to this table's folders. Both start a history of their own."""
        c = self._commit(version, timestamp)
        t = VersionedTable(self.spark, path)
        if t.exists():
            raise ValueError(f"{path} already holds a versioned table")
        params = {"source": self.path, "version": c.version}
        settings = {**c.settings, "change_feed_from": None}
        if deep:
            columns = [{**x, "physical": x["name"]} for x in c.columns]
            if settings["partition_by"]:
                settings["partition_by"] = next(x["name"] for x in c.columns if x["physical"] == settings["partition_by"])
            t._write(Commit(-1, None, "", {}, 0, columns, [], settings), self._rows(c, c.parts), [], "CLONE", params)
        else:
            parts = [(p[0] or self.path, *p[1:]) for p in c.parts]
            t._record(Commit(0, None, "SHALLOW CLONE", params, c.n_rows, c.columns, parts, settings))
        return t

    def describe(self, version: int | None = None) -> DataFrame:
        c = self._commit(version)
        rows = [(f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment")) for f in c.schema()]
        return self.spark.createDataFrame(rows, "col_name string, data_type string, comment string")

    def detail(self) -> DataFrame:
        """Files and bytes of the current version, listed on the executors, with the table's settings."""
        c = self._commit()
        pcol = c.settings.get("partition_by")
        paths = [self._folder(p[0] or self.path, p, pcol) for p in c.parts]
        if paths:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths)
            files = files.select("length")
        else:
            files = self.spark.createDataFrame([], "length long")
        return files.agg(F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_in_bytes")).select(
            F.lit(self.path).alias("location"), F.lit(c.version).cast("long").alias("version"), F.lit(len(c.parts)).cast("long").alias("num_parts"),
            "num_files", "size_in_bytes", F.lit(c.n_rows).cast("long").alias("n_rows"), F.lit(json.dumps(c.settings)).alias("settings"),
        )


def _nullable(t: T.DataType) -> T.DataType:
    """Stored columns may hold NULL at every level, as parquet does."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _nullable(t.valueType), True)
    return t


# A folder name cannot be empty: Spark writes an empty text as if it were NULL. So folders carry '=' for it, and texts
# that begin with '=' get one more.


def _code(text: str) -> str:
    return "=" + text if text == "" or text.startswith("=") else text


def _encoded(df: DataFrame, pcol: str) -> DataFrame:
    if not isinstance(df.schema[pcol].dataType, T.StringType):
        return df
    x = F.col(pcol)
    return df.withColumn(pcol, F.when((x == "") | x.startswith("="), F.concat(F.lit("="), x)).otherwise(x))


def _decoded(df: DataFrame, pcol: str) -> DataFrame:
    if not isinstance(df.schema[pcol].dataType, T.StringType):
        return df
    x = F.col(pcol)
    return df.withColumn(pcol, F.when(x.startswith("="), F.substr(x, F.lit(2))).otherwise(x))


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete the files of a write that was refused."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _columns(df: DataFrame) -> list[dict]:
    return [{"name": f.name, "physical": f.name, "type": _nullable(f.dataType).json(), "comment": (f.metadata or {}).get("comment")} for f in df.schema]


def _ts(spark: SparkSession, t) -> datetime:
    return spark.range(1).select(F.lit(t).cast("timestamp")).first()[0]


def _folder_value(folder: str | None) -> str | None:
    """The partition value a folder name such as ``day=2024-01-01`` stands for, as Spark casts it to text."""
    if folder is None or folder.endswith("=__HIVE_DEFAULT_PARTITION__"):
        return None
    return unquote(folder.split("=", 1)[1])
