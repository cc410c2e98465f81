"""Table changes as functions from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T


def _expr(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _holds(where: str | Column) -> Column:
    """A predicate that is NULL does not hold."""
    return F.coalesce(_expr(where), F.lit(False))


def update(df: DataFrame, set: Mapping[str, str | Column], where: str | Column | None = None) -> DataFrame:
    """Set columns where the predicate holds; every expression sees the row as it was before."""
    unknown = [c for c in set if c not in df.columns]
    if unknown:
        raise ValueError(f"no such column: {unknown}")
    new = {c: _expr(e).cast(df.schema[c].dataType) for c, e in set.items()}
    if where is not None:
        new = {c: F.when(_holds(where), e).otherwise(F.col(c)) for c, e in new.items()}
    return df.withColumns(new)


def delete(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    """Remove the rows where the predicate holds; without a predicate, all rows."""
    return df.where(~_holds(where)) if where is not None else df.where(F.lit(False))


def append(df: DataFrame, rows: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Add rows by column name; ``cols`` names the columns of ``rows`` by position. Missing columns are NULL."""
    return df.unionByName(conform(rows, df.schema, cols))


def conform(rows: DataFrame, schema: T.StructType, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast and order ``rows`` to ``schema``, filling absent columns with NULL; unknown columns are an error."""
    if cols is not None:
        rows = rows.toDF(*cols)
    extra = [c for c in rows.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns not in the table: {extra}")
    have = {c for c in rows.columns}
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def ambiguous_keys(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys with several source rows that also exist in the target: a merge could not tell which row wins."""
    twice = source.groupBy(*on).count().where("count > 1").select(*on)
    return twice.join(target.select(*on), list(on), "left_semi")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str],
    matched: str | Mapping[str, str] | None = "update_all",
    not_matched: str | None = "insert_all",
    check: bool = True,
) -> DataFrame:
    """Upsert ``source`` into ``target`` on equal key columns.

    ``matched``      "update_all", a mapping {column: SQL over s.* and t.*}, or None (leave matched rows)
    ``not_matched``  "insert_all" or None
    Two joins instead of a full outer join: with a small source both are broadcast joins and the target
    is not shuffled at all, and a hot target key can be split, which a full outer join cannot.
    """
    on = [on] if isinstance(on, str) else list(on)
    if check and matched is not None and not ambiguous_keys(target, source, on).isEmpty():
        raise ValueError("a target row matches more than one source row")
    out = merge_updates(target, source, on, matched)
    if not_matched == "insert_all":
        out = out.unionByName(merge_inserts(target, source, on))
    return out


def merge_updates(target: DataFrame, source: DataFrame, on: Sequence[str], matched) -> DataFrame:
    """The target rows after the matched branch of a merge."""
    if matched is None:
        return target
    if matched == "update_all":
        matched = {c: f"s.{c}" for c in source.columns if c in target.columns and c not in on}
    s = source.withColumn("_hit", F.lit(True)).alias("s")
    j = target.alias("t").join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on], "left")
    cols = []
    for f in target.schema:
        if f.name in matched:
            cols.append(F.when(F.col("_hit"), F.expr(matched[f.name]).cast(f.dataType)).otherwise(F.col(f"t.{f.name}")).alias(f.name))
        else:
            cols.append(F.col(f"t.{f.name}").alias(f.name))
    return j.select(*cols)


def merge_inserts(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The source rows without a target row, shaped like the target."""
    on = list(on)
    seen = target.select(*on).join(source.select(*on), on, "left_semi").distinct()
    return conform(source.join(seen, on, "left_anti"), target.schema)


def add_column(df: DataFrame, name: str, type_: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(type_))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def comment_column(df: DataFrame, name: str, comment: str) -> DataFrame:
    return df.withMetadata(name, {**(df.schema[name].metadata or {}), "comment": comment})


def _comparable(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns as values that can be hashed: maps as sorted entries, variants as JSON text."""
    def of(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.MapType):
            return F.to_json(F.array_sort(F.transform(F.map_entries(c), lambda e: F.to_json(e))))
        if isinstance(t, T.VariantType) or "map<" in t.simpleString() or "variant" in t.simpleString():
            return F.to_json(c) if not isinstance(t, T.VariantType) else c.cast("string")
        return c

    return [of(F.col(c), df.schema[c].dataType) for c in columns]


def surplus(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(_row, _side, _h, _turn by key, side): rows that one snapshot holds more often than the other; _side is old or new.

    Equal rows cancel each other, by two hashes of the whole row, counted on the map side whatever their number.
    """
    cols = new.columns
    tagged = lambda df, n: df.select(F.struct(*cols).alias("_row"), *[F.xxhash64(F.lit(i), *_comparable(df, cols)).alias(f"_h{i}") for i in (1, 2)], F.lit(n).alias("_n"))
    net = tagged(old.select(*cols), -1).unionByName(tagged(new, 1)).groupBy("_h1", "_h2").agg(F.sum("_n").alias("_n"), F.first("_row").alias("_row")).where("_n <> 0")
    copies = net.select("_row", "_h1", "_h2", F.when(F.col("_n") > 0, "new").otherwise("old").alias("_side"), F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n"))).alias("_copy"))
    w = W.partitionBy(*[F.col("_row")[k] for k in key], "_side").orderBy("_h1", "_h2", "_copy")
    return copies.withColumn("_turn", F.row_number().over(w))


def diff(old: DataFrame, new: DataFrame, key: str | Sequence[str] | None) -> DataFrame:
    """Row changes between two snapshots with ``_change_type``; one update gives two rows.

    With a key: insert, delete, update_preimage, update_postimage. Equal rows are taken off first, so a row that stands in both
    snapshots is no change, however many rows share its key. What is left of a key is paired in the order of a hash, as far as both
    sides have rows; the rest are inserts or deletes. Without a key the snapshots are compared as bags, which can only tell inserts from deletes.
    """
    cols = new.columns
    old = old.select(*cols)
    if key is None:
        ins = new.exceptAll(old).withColumn("_change_type", F.lit("insert"))
        return ins.unionByName(old.exceptAll(new).withColumn("_change_type", F.lit("delete")))
    key = [key] if isinstance(key, str) else list(key)
    left = surplus(old, new, key)
    by = [F.col("_row")[k].alias(f"_k_{k}") for k in key]
    side = lambda s: F.max_by("_row", F.when(F.col("_side") == s, 1)).alias(f"_{s}")
    pairs = left.groupBy(*by, "_turn").agg(side("old"), side("new"))
    tag = lambda c, t: F.struct(F.col(c).alias("row"), F.lit(t).alias("t"))
    images = (
        F.when(F.col("_old").isNull(), F.array(tag("_new", "insert")))
        .when(F.col("_new").isNull(), F.array(tag("_old", "delete")))
        .otherwise(F.array(tag("_old", "update_preimage"), tag("_new", "update_postimage")))
    )
    return pairs.select(F.explode(images).alias("x")).select("x.row.*", F.col("x.t").alias("_change_type"))


def apply_diff(old: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Bring ``old`` forward by a change feed of one step made by ``diff`` with the same unique key."""
    key = [key] if isinstance(key, str) else list(key)
    gone = changes.where(F.col("_change_type").isin("delete", "update_preimage")).select(*key)
    come = changes.where(F.col("_change_type").isin("insert", "update_postimage")).select(*old.columns)
    return old.join(gone, key, "left_anti").select(*old.columns).unionByName(come)


def version_anti_join(current: DataFrame, earlier: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of the current version whose key is not in an earlier one."""
    on = [on] if isinstance(on, str) else list(on)
    return current.join(earlier.select(*on), on, "left_anti").select(*current.columns)
