"""Idempotent file loads into a versioned table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.versioned import VersionedTable
from .schemas import merged

FILE_KEY = ["path", "length", "modificationTime"]


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files below a folder with size and time; the listing is distributed and no content is read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select(*FILE_KEY)


def loaded_files(table: VersionedTable) -> DataFrame:
    """Files of all committed loads."""
    spark = table.spark
    empty = spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    if not table.exists():
        return empty
    done = table.history().where(F.col("operation") == "COPY").select(F.get_json_object("params", "$.load").alias("_load"))
    try:
        ledger = spark.read.parquet(f"{table.path}/loads")
    except AnalysisException:
        return empty
    return ledger.join(done, "_load", "left_semi").select(*FILE_KEY)


def new_files(table: VersionedTable, src: str, glob: str | None = None) -> DataFrame:
    return list_files(table.spark, src, glob).join(loaded_files(table), FILE_KEY, "left_anti")


def _option(options: Mapping[str, str] | None, name: str):
    return next((v for k, v in (options or {}).items() if k.lower() == name), None)


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """{first line: files that begin with it}. One pass over the text; a line per file goes to the driver, beside the file's name."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("at"))
    first = lines.where("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    out: dict[str, list[str]] = {}
    for r in first.orderBy("path").toLocalIterator():
        out.setdefault(r.line.removeprefix("\ufeff"), []).append(r.path)
    return out


def read_csv_by_header(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """CSV files with header lines that may differ: every file is read by its own header, columns meet by name.

    Spark reads all files of one scan by the header of one of them, which moves values to other columns where headers differ. Here files
    of one header are one scan. Inferred types are widened to the narrowest type that holds all files, and read as that type, so that
    text like 007 stays as it is where one file needs text. Columns that a file lacks are NULL. As many scans as there are different headers.
    """
    options = {**dict(options or {}), "header": "true"}
    lists = list(headers(spark, paths).values())
    groups = [spark.read.format("csv").options(**options).load(files) for files in lists]
    if not groups:
        return spark.createDataFrame([], T.StructType())
    whole = merged([g.schema for g in groups])
    typed = {f.name.lower(): f.dataType for f in whole}
    out = None
    for g, files in zip(groups, lists):
        own = T.StructType([T.StructField(f.name, typed[f.name.lower()], True) for f in g.schema])
        part = spark.read.format("csv").options(**options).schema(own).load(files)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(*whole.names)


def copy_into(
    table: VersionedTable,
    src: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
    select: Sequence[str] | None = None,
    merge_schema: bool = False,
    schema: str | None = None,
    glob: str | None = None,
) -> int:
    """Load the files of ``src`` that no earlier load has taken; returns the number of files loaded.

    The names of the files and the rows become visible by one commit, whatever their number, so a load that
    failed can be repeated, and a repeated load adds nothing. The names are written by Spark; the driver holds
    them once, as the reader's own file index does. The table is created by its first load. Schema inference
    looks at the new files only; with ``merge_schema`` the files of a load may differ in their columns (CSV files with a
    header are read by their own), and columns that the table lacks are added. The table's types hold: a value that cannot be cast fails the
    load. ``select`` is a projection applied to the loaded rows.
    """
    spark = table.spark
    load = uuid.uuid4().hex[:12]
    names = f"{table.path}/loads/_load={load}"
    new_files(table, src, glob).write.parquet(names)  # not a part of the table until the commit that names it
    paths = [r.path for r in spark.read.parquet(names).select("path").orderBy("path").toLocalIterator()]
    if not paths:
        return 0
    if merge_schema and not schema and fmt == "csv" and str(_option(options, "header")).lower() == "true":
        df = read_csv_by_header(spark, paths, options)
    else:
        r = spark.read.format(fmt).options(**dict(options or {}))
        if merge_schema:
            r = r.option("mergeSchema", "true")
        if schema:
            r = r.schema(schema)
        df = r.load(paths)
    if select:
        df = df.selectExpr(*select)
    params = {"load": load, "files": len(paths), "source": src}
    if table.exists():
        table.append(df, operation="COPY", params=params, merge_schema=merge_schema)
    else:
        VersionedTable.create(df, table.path, operation="COPY", params=params)
    return len(paths)
