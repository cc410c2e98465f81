"""Incremental file streams and run-once writes."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T


def stored_schema(spark: SparkSession, schema_dir: str, path: str, fmt: str, options: Mapping | None = None, nested_as_text: bool = False) -> T.StructType:
    """The schema kept beside a checkpoint; inferred from the files present on the first use only.

    ``nested_as_text`` declares structs and arrays as STRING: the JSON reader then returns their JSON text.
    """
    try:
        text = spark.read.text(schema_dir, wholetext=True).first()
        if text:
            return T.StructType.fromJson(json.loads(text[0]))
    except AnalysisException:
        pass
    st = spark.read.format(fmt).options(**dict(options or {})).load(path).schema
    if nested_as_text:
        flat = lambda t: T.StringType() if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else t
        st = T.StructType([T.StructField(f.name, flat(f.dataType)) for f in st])
    spark.createDataFrame([(st.json(),)], "value string").coalesce(1).write.mode("error").text(schema_dir)
    return st


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: str | T.StructType | None = None,
    schema_dir: str | None = None,
    options: Mapping | None = None,
    nested_as_text: bool = False,
    max_files: int | None = None,
    rescue: bool = False,
) -> DataFrame:
    """A stream of the files that arrive under ``path``; each file is read once per checkpoint.

    ``rescue`` (JSON) adds ``_rescued_data`` with all that the kept schema cannot hold: new fields, values of another
    type, malformed records. Without it these are lost, as with any fixed schema.
    """
    if schema is None:
        if schema_dir is None:
            raise ValueError("give a schema, or a folder to keep the inferred one in")
        schema = stored_schema(spark, schema_dir, path, fmt, options, nested_as_text)
    if rescue:
        if fmt != "json":
            raise ValueError("only JSON can be rescued")
        from ..sources.files import with_rescued

        r = spark.readStream
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        return with_rescued(r.text(path), schema)
    r = spark.readStream.format(fmt).schema(schema).options(**dict(options or {}))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def stream_json_rescued(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A JSON file stream that keeps fields outside the schema in ``_rescued_data``."""
    from ..sources.files import with_rescued

    return with_rescued(spark.readStream.text(path), schema)


def run_available_now(sdf: DataFrame, path: str, checkpoint: str, table: str | None = None, continuous: str | None = None):
    """Write what is available and stop; ``continuous`` (an interval such as "10 seconds") keeps running.

    The sink is parquet files, whose commit log together with the checkpoint makes every row land once.
    """
    w = sdf.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=continuous) if continuous else w.trigger(availableNow=True)
    q = w.option("path", path).toTable(table) if table else w.start(path)
    if not continuous:
        q.awaitTermination()
    return q
