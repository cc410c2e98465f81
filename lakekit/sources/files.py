"""Files in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_json(spark: SparkSession, path, schema: str | T.StructType | None = None) -> DataFrame:
    """JSON lines; without a schema Spark infers it in one extra pass, so give one for large inputs."""
    r = spark.read.schema(schema) if schema else spark.read
    return r.json(path)


def read_csv(spark: SparkSession, path, infer: bool = True, sep: str = ",", quote: str = '"', schema=None) -> DataFrame:
    """CSV with a header line. ``infer=False`` keeps every column a string. A byte order mark is ignored."""
    r = spark.read.option("header", True).option("sep", sep).option("quote", quote)
    # a quote inside a quoted field is written twice
    r = r.option("escape", quote)
    r = r.schema(schema) if schema else r.option("inferSchema", infer)
    return r.csv(path)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def query_path(spark: SparkSession, fmt: str, path: str, select: str = "*") -> DataFrame:
    """Query files by path, without a table."""
    if "`" in path or not fmt.isalnum():
        raise ValueError("bad path or format")
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}`")


def json_text_to_df(df: DataFrame, col: str, schema: str | T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON documents held as text, as an API answers them, to columns."""
    parsed = df.select(*keep, F.from_json(col, schema).alias("_j"))
    return parsed.select(*keep, "_j.*")


def _lost(raw: Column, value: Column, kind: T.DataType, path: Column) -> Column:
    """array<struct<k, v>>: what the JSON text ``raw`` holds and ``value``, its reading as ``kind``, does not, by path.

    Objects, arrays and maps are compared part by part: a value of a wrong type goes by its own path, a field outside a struct by its
    name there. An element or field that is NULL in the text is no loss.
    """
    entry = lambda k, v: F.array(F.struct(k.alias("k"), v.alias("v")))
    none = F.array().cast("array<struct<k: string, v: string>>")
    if isinstance(kind, T.StructType):
        m = F.from_json(raw, "map<string,string>")
        def of(e: Column) -> Column:
            known = F
            for f in kind:
                known = known.when(e["key"] == f.name, _lost(e["value"], value[f.name], f.dataType, _step(path, F.lit(f.name))))
            new = entry(_step(path, e["key"]), e["value"])
            return known.otherwise(new) if kind.fields else new

        return F.when(raw.isNull(), none).when(m.isNull(), entry(path, raw)).otherwise(F.flatten(F.transform(F.map_entries(m), of)))
    if isinstance(kind, T.ArrayType):
        items = F.from_json(raw, "array<string>")
        each = F.transform(items, lambda x, i: _lost(x, F.try_element_at(value, i + 1), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.when(raw.isNull(), none).when(items.isNull(), entry(path, raw)).otherwise(F.flatten(each))
    if isinstance(kind, T.MapType):
        m = F.from_json(raw, "map<string,string>")
        each = F.transform(F.map_entries(m), lambda e: _lost(e["value"], F.try_element_at(value, e["key"].cast(kind.keyType)), kind.valueType, _step(path, e["key"])))
        return F.when(raw.isNull(), none).when(m.isNull(), entry(path, raw)).otherwise(F.flatten(each))
    return F.when(raw.isNotNull() & value.isNull(), entry(path, raw)).otherwise(none)


def _step(path: Column, name: Column) -> Column:
    """path.name, or path['name'] where the name holds a mark that paths use."""
    odd = F.concat(path, F.lit("['"), F.replace(name, F.lit("'"), F.lit("\\'")), F.lit("']"))
    plain = F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))
    return F.when(name.rlike(r"[.'\[\]]"), odd).otherwise(plain)


def with_rescued(df_text: DataFrame, schema: str | T.StructType, col: str = "value") -> DataFrame:
    """Parse JSON text by a schema and keep what it cannot hold as JSON in ``_rescued_data`` (else NULL).

    That is every field outside the schema and every value of a wrong type (it is NULL in its column), at any depth: the names are
    paths like ``order.lines[2].price``. Of a text that is no JSON object, the whole text goes there under the name ``_malformed``.
    """
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    rest = [c for c in df_text.columns if c != col]
    out = df_text.select(*rest, F.from_json(col, st).alias("_j"), F.from_json(col, "map<string,string>").alias("_m"), F.col(col).alias("_t"))
    bad = F.col("_m").isNull() & (F.trim(F.col("_t")) != "")
    lost = F.map_from_entries(_lost(F.col("_t"), F.col("_j"), st, F.lit("")))
    out = out.withColumn("_x", F.when(bad, F.create_map(F.lit("_malformed"), F.col("_t"))).when(F.col("_m").isNotNull(), lost))
    return out.select(*rest, "_j.*", F.when(F.size("_x") > 0, F.to_json("_x")).alias("_rescued_data"))


def with_provenance(df: DataFrame) -> DataFrame:
    """Source file and processing time of every row; only for frames that read files directly."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("processed_at"))


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", files: int | None = None, options: Mapping | None = None) -> None:
    """Write files. ``files`` sets their number, by an even shuffle.

    One file means one writing task, so ask for that only with small outputs.
    """
    if files is not None:
        df = df.repartition(files)
    df.write.mode(mode).format(fmt).options(**dict(options or {})).save(path)


def save_table(df: DataFrame, name: str, mode: str = "error", path: str | None = None) -> None:
    """Save as a named table; an existing one is an error unless ``mode`` says otherwise."""
    w = df.write.mode(mode).format("parquet")
    (w.option("path", path) if path else w).saveAsTable(name)


def ctas(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    if_exists: str = "error",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Create a table from a query. ``if_exists``: "error", "ignore" (keep the old one) or "replace".

    With partition columns the rows of a partition value are gathered first, so it gets few files; a
    value too large for one task is split by AQE (REBALANCE), which a plain repartition would not do.
    ``sort_by`` sorts inside each file, which makes row-group statistics selective.
    """
    if if_exists == "ignore" and spark.catalog.tableExists(name):
        return spark.table(name)
    if if_exists == "replace":
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = df.write.mode("error").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    (w.option("path", path) if path else w).saveAsTable(name)
    return spark.table(name)


def rows(spark: SparkSession, data: Sequence, schema: str | T.StructType) -> DataFrame:
    """Literal rows with a declared schema."""
    return spark.createDataFrame(data, schema)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


# --- exports of slices ------------------------------------------------------------------------------


def slice_rows(df: DataFrame, location: str | None = None, date: str | None = None, loc_col: str = "location", date_col: str = "ts_date") -> DataFrame:
    """The rows of one location and day with an export stamp; on a table partitioned by these columns
    the filter prunes partitions."""
    if location is not None:
        df = df.where(F.col(loc_col) == location)
    if date is not None:
        df = df.where(F.col(date_col) == F.lit(date).cast(df.schema[date_col].dataType))
    return df.withColumn("exported_ts", F.unix_timestamp())


def correction_rows(df: DataFrame, state_col: str, ts_col: str, pending: str = "PENDING", cancelled: str = "CANCELED") -> DataFrame:
    """Pending rows again, now cancelled, with the unix time shown as text."""
    out = df.where(F.col(state_col) == pending)
    return out.withColumns({state_col: F.lit(cancelled), ts_col: F.from_unixtime(ts_col)})


def export_slice(df: DataFrame, base: str, location: str, date: str, loc_col: str = "location", date_col: str = "ts_date") -> str:
    """One location and day to a folder of its own as JSON; as many files as the rows need."""
    path = f"{base}/{location}/{date}/daily_sales"
    write_files(slice_rows(df, location, date, loc_col, date_col).drop(date_col).hint("rebalance"), path, "json")
    return path


def export_corrections(df: DataFrame, base: str, location: str, date: str, state_col: str = "state", ts_col: str = "ts", loc_col: str = "location", date_col: str = "ts_date") -> str:
    path = f"{base}/{location}/{date}/updated_daily_sales"
    out = correction_rows(slice_rows(df, location, date, loc_col, date_col), state_col, ts_col)
    write_files(out.drop(date_col).hint("rebalance"), path, "json")
    return path


def export_all(df: DataFrame, base: str, loc_col: str = "location", date_col: str = "ts_date") -> str:
    """All locations and days in one distributed write, one folder each."""
    out = df.withColumn("exported_ts", F.unix_timestamp()).hint("rebalance", loc_col, date_col)
    out.write.mode("overwrite").partitionBy(loc_col, date_col).json(base)
    return base


# --- samples ----------------------------------------------------------------------------------------


def sample(df: DataFrame, fraction: float, seed: int | None = 42) -> DataFrame:
    """Bernoulli sample; with a seed it repeats only while the partitions stay the same."""
    return df.sample(False, fraction, seed)


def key_share(key: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed only, never on partitions or retries."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def stable_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample by key: the same rows on every run and cluster."""
    return df.where(key_share(key, seed) < fraction)
