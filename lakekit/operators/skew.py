"""Ordered scans per key that stay balanced when one key holds a large share of the rows.

``lead``, "last known value" and running sums need the rows of a key in order. A plain window sends a key to one
task, which fails when a key holds a third of the table. Here the rows are dealt out by ranges of (key, sequence, tie, row hash, row number), so every
range is about as large as any other, whatever the keys and however many rows are equal; a key may run over many ranges. The rows are written once with the number of
their range and scanned inside it. Only the first and the last key of a range can go on in another one: for these a table with one
row per range and key, at most two per range, carries the state across the borders. The same path serves tables of all sizes and keys of all shares.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..session import workdir


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    """Equal columns; NULL is a value like any other."""
    cond = F.lit(True)
    for x, y in zip(a, b):
        cond = cond & F.col(x).eqNullSafe(F.col(y))
    return cond


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _hashable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return not isinstance(t, (T.MapType, T.VariantType))


def ranges_for(df: DataFrame, most_bytes: int = 512 << 20) -> int:
    """As many ranges as the session has shuffle partitions, and more where the tables that ``df`` reads would put over ``most_bytes`` in one."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(n for n in sizes if n < 1 << 62)  # a source that does not know its size says the largest number
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // most_bytes))


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None, spread_equal: bool = True) -> DataFrame:
    """The rows with the number ``_p`` of their range in (keys, order, row hash, row number); written once, so numbers and rows stay together.

    The row number counts the rows of an input task, sorted by their hash first: a task that runs again numbers equal rows as before,
    whatever order its rows come in. Without ``spread_equal`` (for rows known to differ) there is no number and no sort.
    """
    spark = df.sparkSession
    n = ranges or ranges_for(df)
    fixed = [F.col(c) if _hashable(df.schema[c].dataType) else F.to_json(F.struct(c)) for c in df.columns]
    cut = df.withColumn("_h", F.xxhash64(*fixed))
    if spread_equal:
        cut = cut.sortWithinPartitions("_h").withColumn("_i", F.monotonically_increasing_id())
    extra = ["_h", "_i"] if spread_equal else ["_h"]
    cut = cut.repartitionByRange(n, *keys, *order, *extra).withColumn("_p", F.spark_partition_id()).drop(*extra)
    path = workdir(spark, "ranges")
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def borders(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_p, keys) of the first and the last key of every range, where the key is in more than one; at most two rows per range."""
    k = F.struct(*keys)
    ends = src.groupBy("_p").agg(F.array_distinct(F.array(F.min(k), F.max(k))).alias("_e")).select("_p", F.explode("_e").alias("_k")).select("_p", *[F.col("_k")[c].alias(c) for c in keys])
    many = ends.groupBy(*keys).count().where("count > 1").select(*[F.col(c).alias(f"_m_{c}") for c in keys])
    return ends.join(many, _same(keys, [f"_m_{c}" for c in keys]), "left_semi")


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    tie: Sequence[str] = (),
    lead: Mapping[str, str] | None = None,
    last: Mapping[str, str] | None = None,
    running: Mapping[str, str] | None = None,
    reset: str | None = None,
    ranges: int | None = None,
    spread_equal: bool = True,
) -> DataFrame:
    """Scan the rows of every key in ``seq``, ``tie`` order and add columns; NULLs come first.

    ``lead``     {new: column}  the column on the next row of the key
    ``last``     {new: column}  last non-NULL value so far, this row included; rows whose boolean
                                ``reset`` column is true forget everything before and hold no value
    ``running``  {new: column}  running sum, this row included
    ``ranges``   how many ranges to deal the rows to; from the session and the bytes read if not given
    ``spread_equal``  deal equal rows to several ranges as well; not needed where no two rows are equal
    """
    lead, last, running = dict(lead or {}), dict(last or {}), dict(running or {})
    keys, columns = list(keys), df.columns
    order = list(dict.fromkeys([*seq, *tie]))
    if reset:
        for c in set(last.values()):
            df = df.withColumn(c, F.when(~F.coalesce(F.col(reset), F.lit(False)), F.col(c)))
    src = ranged(df, keys, order, ranges, spread_equal)
    rst = F.coalesce(F.col(reset), F.lit(False)).cast("long") if reset else F.lit(0).cast("long")

    w = W.partitionBy("_p", *keys).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    add = {f"_lead_{n}": F.lead(c).over(w) for n, c in lead.items()}
    add |= {f"_run_{n}": F.sum(c).over(upto) for n, c in running.items()}
    add |= {"_end": F.lead(F.lit(True)).over(w).isNull(), "_life": F.sum(rst).over(upto) if reset else F.lit(0).cast("long")}
    out = src.withColumns(add)
    if last:
        # same partitioning and order as above: a second window step without a second sort
        out = out.withColumns({f"_last_{n}": F.last(F.when(F.col(c).isNotNull(), F.struct("_life", F.col(c).alias("v"))), True).over(upto) for n, c in last.items()})
        out = out.withColumns({f"_last_{n}": F.when(F.col(f"_last_{n}._life") == F.col("_life"), F.col(f"_last_{n}.v")) for n in last})

    carry = _carry(src, keys, order, rst, lead, last, running)
    j = out.join(carry, (F.col("_p") == F.col("_cp")) & _same(keys, [f"_ck_{k}" for k in keys]), "left")
    res = {n: F.when(F.col("_end") & F.col("_cp").isNotNull(), F.col(f"_c_lead_{n}")).otherwise(F.col(f"_lead_{n}")) for n in lead}
    res |= {n: F.when(F.col(f"_run_{n}").isNull(), F.col(f"_c_run_{n}")).otherwise(F.col(f"_run_{n}") + F.coalesce(F.col(f"_c_run_{n}"), F.lit(0))) for n in running}
    res |= {n: F.coalesce(F.col(f"_last_{n}"), F.when(F.col("_life") == 0, F.col(f"_c_last_{n}"))) for n in last}
    return j.select(*columns, *[v.alias(n) for n, v in res.items()])


def _carry(src: DataFrame, keys, order, rst: Column, lead, last, running) -> DataFrame:
    """State at the start of every range for the keys that run over its borders: one row per (_p, key) of ``borders``."""
    edge = borders(src, keys).select(F.col("_p").alias("_bp"), *[F.col(k).alias(f"_b_{k}") for k in keys])
    rows = src.join(edge, (F.col("_p") == F.col("_bp")) & _same(keys, [f"_b_{k}" for k in keys]), "left_semi")
    pos = F.struct(*order)
    agg = [F.sum(rst).alias("_resets"), F.max(F.when(rst > 0, pos)).alias("_rpos")]
    agg += [F.min_by(F.struct(F.col(c).alias("v")), pos).alias(f"_f_{n}") for n, c in lead.items()]
    agg += [F.sum(c).alias(f"_s_{n}") for n, c in running.items()]
    agg += [F.max_by(F.struct(pos.alias("p"), F.col(c).alias("v")), F.when(F.col(c).isNotNull(), pos)).alias(f"_t_{n}") for n, c in last.items()]
    s = rows.groupBy("_p", *keys).agg(*agg)
    w = W.partitionBy(*keys).orderBy("_p")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("_lend", F.sum("_resets").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    cols = [F.col("_p").alias("_cp"), *[F.col(k).alias(f"_ck_{k}") for k in keys]]
    for n in lead:
        cols.append(F.lead(F.col(f"_f_{n}.v")).over(w).alias(f"_c_lead_{n}"))
    for n in running:
        cols.append(F.sum(f"_s_{n}").over(before).alias(f"_c_run_{n}"))
    for n in last:
        t = F.col(f"_t_{n}")
        tail = F.when(t.isNotNull() & (F.col("_rpos").isNull() | (t["p"] > F.col("_rpos"))), F.struct(F.col("_lend").alias("l"), t["v"].alias("v")))
        s = s.withColumn(f"_tail_{n}", tail)
        prev = F.last(F.col(f"_tail_{n}"), True).over(before)
        cols.append(F.when(prev["l"] == F.col("_lend") - F.col("_resets"), prev["v"]).alias(f"_c_last_{n}"))
    return s.select(*cols)
