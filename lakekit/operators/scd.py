"""Change data capture: apply a change log as a type 1 (current state) or type 2 (history) dimension.

``apply_changes`` is the batch form over a whole log. Type 1 is a plain aggregate (newest row per key),
so a hot key is combined on the map side. Type 2 and null carry use ``ordered_scan``.
Changes with equal key and sequence are one change: ``tie_by`` orders them and the last one wins, with NULLs
filled from the earlier ones when ``ignore_null_updates`` is set. Without ``tie_by`` the order is the change
type, then every other column; when NULL updates are ignored, a hash of the row stands for the other columns,
since the position of every column's newest value has to be kept. A NULL sequence is the earliest one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .skew import ordered_scan

START, END = "__START_AT", "__END_AT"


def _names(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _expr(e: str | Column | None) -> Column | None:
    return F.expr(e) if isinstance(e, str) else e


def _orderable(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns that can break a tie; map and variant values have no order."""
    def ok(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        return not isinstance(t, (T.MapType, T.VariantType))

    return [n for n in names if ok(df.schema[n].dataType)]


def _with_tie(df: DataFrame, keys, seq, tie_by, ignore_null: bool) -> tuple[DataFrame, list[str]]:
    if tie_by is not None:
        return df, _names(tie_by)
    rest = [c for c in df.columns if c not in keys and c not in seq and c != "_del"]
    kind = [c for c in rest if c == "_change_type"]
    if not ignore_null:
        return df, _orderable(df, kind + [c for c in rest if c not in kind])
    hashed = _orderable(df, sorted(rest)) or list(keys)
    return df.withColumn("_rowhash", F.xxhash64(*hashed)), [*kind, "_rowhash"]


def apply_changes(
    changes: DataFrame,
    keys: str | Sequence[str],
    sequence_by: str | Sequence[str],
    delete_when: str | Column | None = None,
    ignore_null_updates: bool = False,
    except_cols: Sequence[str] = (),
    scd_type: int = 1,
    tie_by: str | Sequence[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Apply ``changes`` (a batch DataFrame holding the whole log) and return the dimension."""
    keys, seq = _names(keys), _names(sequence_by)
    if scd_type == 1:
        state = scd1_state(changes, keys, seq, delete_when, ignore_null_updates, tie_by)
        return scd1_view(state, [c for c in changes.columns if c not in except_cols])
    if scd_type != 2:
        raise ValueError("scd_type must be 1 or 2")
    return _scd2(changes, keys, seq, _expr(delete_when), ignore_null_updates, list(except_cols), tie_by, ranges)


# --- type 1 -----------------------------------------------------------------------------------------
# The state of a key is a set of maxima, so states merge like partial aggregates: the state of
# (log a + log b) is the merge of both states in any order. Streaming keeps only this state.


def scd1_state(
    changes: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    delete_when: str | Column | None = None,
    ignore_null_updates: bool = False,
    tie_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: ``_top`` (position and row of the newest change, deletes included) and, when NULL
    updates are ignored, ``_del_at`` (position of the newest delete) and ``_v`` with position and value of the
    newest non-NULL entry of every column."""
    dele = F.coalesce(_expr(delete_when), F.lit(False)) if delete_when is not None else F.lit(False)
    df, tie = _with_tie(changes.withColumn("_del", dele), keys, seq, tie_by, ignore_null_updates)
    pos_cols = [*seq, *[c for c in tie if c not in seq]]
    pos = F.struct(*pos_cols)
    rest = [c for c in changes.columns if c not in keys]
    other = [c for c in rest if c not in pos_cols]
    # every column once: the position, the delete mark, the other columns
    top = F.struct(*pos_cols, "_del", *other)
    newest = F.max(top) if len(_orderable(changes, other)) == len(other) else F.max_by(top, pos)
    agg = [newest.alias("_top")]
    if ignore_null_updates:
        agg.append(F.max(F.when(F.col("_del"), pos)).alias("_del_at"))
        vals = []
        for c in rest:
            live = F.col(c).isNotNull() & ~F.col("_del")
            vals.append(F.max_by(F.struct(pos.alias("p"), F.col(c).alias("x")), F.when(live, pos)).alias(c))
        agg.append(F.struct(*vals).alias("_v"))
    return df.groupBy(*keys).agg(*agg)


def scd1_merge(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge two states made by ``scd1_state`` with the same arguments."""
    u = a.unionByName(b)
    pos = F.struct(*[F.col("_top")[c] for c in _top_fields(a)[0]])
    agg = [F.max_by("_top", pos).alias("_top")]
    if "_v" in a.columns:
        agg.append(F.max("_del_at").alias("_del_at"))
        fields = a.schema["_v"].dataType.fieldNames()
        agg.append(F.struct(*[F.max_by(F.col("_v")[c], F.col("_v")[c]["p"]).alias(c) for c in fields]).alias("_v"))
    return u.groupBy(*keys).agg(*agg)


def _top_fields(state: DataFrame) -> tuple[list[str], list[str]]:
    """(columns of the position, other columns) of ``_top``"""
    names = state.schema["_top"].dataType.fieldNames()
    at = names.index("_del")
    return names[:at], names[at + 1:]


def scd1_view(state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Current rows of a type 1 state."""
    live = state.where(~F.col("_top._del"))
    pos, other = _top_fields(state)
    out = []
    for c in columns:
        if c not in pos and c not in other:
            out.append(F.col(c))
        elif "_v" in state.columns:
            v = F.col("_v")[c]
            ok = F.col("_del_at").isNull() | (v["p"] > F.col("_del_at"))
            out.append(F.when(ok, v["x"]).alias(c))
        else:
            out.append(F.col("_top")[c].alias(c))
    return live.select(*out)


# --- type 2 -----------------------------------------------------------------------------------------


def _scd2(changes, keys, seq, delete_when, ignore_null, except_cols, tie_by, ranges) -> DataFrame:
    df = changes.withColumn("_del", F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False))
    df, tie = _with_tie(df, keys, seq, tie_by, ignore_null)
    payload = [c for c in changes.columns if c not in keys and c not in except_cols]
    df = df.withColumn("_seq", F.col(seq[0]) if len(seq) == 1 else F.struct(*seq))
    # value columns are scanned under their own name so the tie columns stay untouched
    last = {}
    if ignore_null:
        df = df.withColumns({f"_p_{c}": F.col(c) for c in payload})
        last = {f"_o_{c}": f"_p_{c}" for c in payload}
    s = ordered_scan(
        df.withColumn("_one", F.lit(1)), keys, seq, tie, lead={"_next": "_seq", "_after": "_one"}, last=last, reset="_del" if ignore_null and delete_when is not None else None,
        ranges=ranges,
    )
    # of changes with the same sequence only the last one opens or closes an interval; the last row of a key has no next one
    s = s.where((F.col("_after").isNull() | ~F.col("_seq").eqNullSafe(F.col("_next"))) & ~F.col("_del"))
    val = (lambda c: F.col(f"_o_{c}").alias(c)) if ignore_null else F.col
    return s.select(*keys, *[val(c) for c in payload], F.col("_seq").alias(START), F.col("_next").alias(END))


# --- use of the history -----------------------------------------------------------------------------


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    start: str = START,
    end: str = END,
    columns: Sequence[str] | None = None,
    how: str = "left",
    ranges: int | None = None,
) -> DataFrame:
    """Give every fact the dimension row valid at its time (``start <= ts < end``, open end = current).

    Facts and interval starts are merged into one ordered scan per key, so the work is linear in the
    rows; a range join would compare every fact of a key with every interval of that key.
    Intervals of one key must not overlap, which holds for type 2 output. A NULL key matches nothing, as in an equi join.
    """
    keys = _names(keys)
    columns = list(columns) if columns is not None else [c for c in history.columns if c not in keys and c not in (start, end)]
    dim = history.select(
        *keys, F.col(start).alias("_t"), F.lit(0).alias("_side"), F.struct(F.col(end).alias("_e"), *columns).alias("_dim"),
    )
    fact = facts.select(*keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), F.struct(*facts.columns).alias("_fact"))
    both = dim.unionByName(fact, allowMissingColumns=True)
    s = ordered_scan(both, keys, ["_t"], ["_side"], last={"_cur": "_dim"}, ranges=ranges)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    valid = known & F.col("_cur").isNotNull() & (F.col("_cur._e").isNull() | (F.col("_t") < F.col("_cur._e")))
    s = s.where(F.col("_side") == 1).withColumn("_ok", F.coalesce(valid, F.lit(False)))
    if how == "inner":
        s = s.where("_ok")
    return s.select("_fact.*", *[F.when(F.col("_ok"), F.col("_cur")[c]).alias(c) for c in columns])


def snapshot_feed(df: DataFrame, change_type: str, at: str) -> DataFrame:
    """A change feed from a snapshot export: the same change type and time on every row."""
    return df.withColumns({"_change_type": F.lit(change_type), "_change_timestamp": F.lit(at)})
