"""The trie of conversation prefixes, with prefixes screened by a count-min sketch.

A node is a distinct sequence of first turns (role and text); the root has none. Its members are the conversations that start with it.

1. *Prefix digests.* Every turn gets a hash of its role, text and place; the running sum of these along a conversation, in four lanes
   of 32 bits, is the digest of the prefix (two 64-bit numbers). Sums are taken by ``ordered_scan``, which cuts a long conversation
   into ranges, so one that holds a third of all turns is spread over the tasks.
2. *Screen.* Every task counts its digests in a count-min sketch of two rows whose cells stop at two; the sketches are merged by cells,
   and one bit per cell ("two or more") goes to all tasks: at most 16 MB, whatever the input (``MOST_CELLS``). The estimate is never
   too low, so an estimate of one proves that a prefix has one member. Such prefixes, the tails, are finished where they stand: nothing
   else is needed but the first one's parent. Where a corpus outgrows the sketch, fewer tails are proved and more prefixes are shuffled;
   the result is the same.
3. *Exact groups.* Prefixes that may be shared are grouped by digest; combined on the map side, so the root or a first turn of
   very many conversations is no group anywhere.
4. *Subtrees.* Every node belongs to its smallest member. What a conversation's own nodes add (leaves, saved bytes) is summed from its
   end upwards, once more by ``ordered_scan``, and summed over the members of each node: no walk level by level.
5. *Ends.* The ids of conversations that end in a node are sorted in Spark and streamed through SHA-256, which takes one value after
   the other by its nature; no list of them is held.

NULL roles and texts are empty ones. Turns are ordered by ``turn``, NULL first; turns of equal number by a hash of role and text, so
repeated rows are turns of their own. Rows without a conversation id take no part. Conversations without turns are members of the root.
Extra columns are not read. An empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import ordered_scan
from .common import mix, stored

LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 26
CHUNK = 1 << 16
_SEEDS = [np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)]
LANES = 4


# ---- turns


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, m, bytes): the turns of every conversation, numbered from 1, with a hash of role and text."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    m = F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t).cast("binary"))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), m.alias("m"), F.octet_length(t).cast("long").alias("bytes"), F.lit(1).cast("long").alias("one"))
    return ordered_scan(rows, ["conv"], ["turn"], ["m"], running={"pos": "one"}, spread_equal=False).select("conv", "pos", "m", "bytes")


def spliced(turns: DataFrame, source: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of conversations whose first turns are another's: the first ``heads`` (a number up to ``most``, over ``conv``)
    turns of conversation ``source`` (all if it has fewer), then the own turns after the first ``heads``."""
    n = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    convs = n.select("conv", "own", source.alias("base"), heads.cast("long").alias("h"))
    first = turns.where(F.col("pos") <= most).select(F.col("conv").alias("base"), "pos", "m", "bytes")
    there = n.select(F.col("conv").alias("base"), F.col("own").alias("n"))
    convs = stored(convs.join(there, "base", "left").select("conv", "base", "h", "own", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")), "conversations")
    taken = convs.where("taken > 0").select("conv", "base", "taken").join(first, "base").where("pos <= taken").select("conv", F.col("pos").alias("depth"), "m", "bytes")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").where("pos > h").select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "m", "bytes")
    return taken.unionByName(own), convs.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))


# ---- digests


def _key(sums: list[Column], depth: Column, seed: int) -> Column:
    return F.when(depth > 0, F.xxhash64(F.lit(seed), depth, *sums)).otherwise(F.lit(0).cast("long"))


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, depth, len, bytes, k1, k2, p1, p2): every prefix of every conversation with its digest and its parent's."""
    lanes = [f"t{i}" for i in range(LANES)]
    both = [F.xxhash64(F.lit(seed), "depth", "m") for seed in (1, 2)]
    halves = [x for b in both for x in (F.shiftrightunsigned(b, 32), b.bitwiseAND(F.lit(0xFFFFFFFF)))]
    rows = turns.withColumns(dict(zip(lanes, halves))).drop("m")
    scan = ordered_scan(rows, ["conv"], ["depth"], running={f"s{i}": f"t{i}" for i in range(LANES)}, spread_equal=False)
    now = [F.col(f"s{i}") for i in range(LANES)]
    before = [F.col(f"s{i}") - F.col(f"t{i}") for i in range(LANES)]
    d = F.col("depth")
    keyed = scan.select("conv", "depth", "bytes", _key(now, d, 3).alias("k1"), _key(now, d, 4).alias("k2"), _key(before, d - 1, 3).alias("p1"), _key(before, d - 1, 4).alias("p2"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = lengths.select("conv", zero.alias("depth"), zero.alias("bytes"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"))
    return keyed.unionByName(root).join(lengths, "conv")


# ---- the screen


def cells_for(n: int) -> int:
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (8 * n - 1).bit_length()))


def cells_of(k1: np.ndarray, k2: np.ndarray, cells: int) -> list[np.ndarray]:
    both = k1.view(np.uint64) ^ mix(k2.view(np.uint64))
    return [(mix(both ^ s) & np.uint64(cells - 1)).astype(np.int64) for s in _SEEDS]


def _count(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """The sketch of a task: cells that stop at two, in packed chunks; chunks without a count are left out."""
    rows = [np.zeros(cells, np.uint8) for _ in _SEEDS]
    for b in batches:
        for row, at in zip(rows, cells_of(b.column("k1").to_numpy(), b.column("k2").to_numpy(), cells)):
            at, n = np.unique(at, return_counts=True)
            row[at] = np.minimum(row[at] + np.minimum(n, 2), 2)
    for i, row in enumerate(rows):
        parts = row.reshape(-1, min(CHUNK, cells))
        some = np.flatnonzero(parts.any(1))
        for at in range(0, len(some), 64):
            these = some[at : at + 64]
            yield pa.record_batch({"chunk": pa.array(these + i * len(parts), pa.int64()), "cells": pa.array([zlib.compress(parts[c].tobytes(), 1) for c in these], pa.binary())})


def _merge(group: pa.Table, last: bool) -> pa.Table:
    """Some sketches' counts of one chunk (at most the partial sketches of a lane, or one of each lane) as one."""
    total = np.zeros(1, np.uint8)
    for x in group.column("cells"):
        total = np.minimum(total + np.frombuffer(zlib.decompress(x.as_py()), np.uint8), 2)
    packed = np.packbits(total == 2).tobytes() if last else zlib.compress(total.tobytes(), 1)
    return pa.table({"chunk": group.column("chunk")[:1], "cells": pa.array([packed], pa.binary())})


def screen(keys: DataFrame, cells: int) -> list[np.ndarray]:
    """Per row of the sketch, one bit per cell: counted twice or more."""
    kind = "chunk long, cells binary"
    part = keys.select("k1", "k2").mapInArrow(lambda bs: _count(bs, cells), kind)
    some = part.withColumn("lane", F.spark_partition_id() % 32).groupBy("chunk", "lane").applyInArrow(lambda g: _merge(g, False), kind)
    whole = some.groupBy("chunk").applyInArrow(lambda g: _merge(g, True), kind)
    bits = [np.zeros(cells // 8, np.uint8) for _ in _SEEDS]
    got = whole.toArrow()  # at most 2 * MOST_CELLS bits
    for c, x in zip(got.column("chunk").to_pylist(), got.column("cells")):
        size = min(CHUNK, cells)
        i, at = divmod(c, cells // size)
        bits[i][at * size // 8 : (at + 1) * size // 8] = np.frombuffer(x.as_py(), np.uint8)
    return bits


def _prove(batches: Iterator[pa.RecordBatch], sketch) -> Iterator[pa.RecordBatch]:
    """Add ``single`` and ``above``: is the prefix, and its parent, proved to have one member?"""
    bits = sketch.value
    cells = 8 * len(bits[0])

    def one(k1: pa.Array, k2: pa.Array) -> np.ndarray:
        proved = np.zeros(len(k1), bool)
        for row, at in zip(bits, cells_of(k1.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), k2.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), cells)):
            proved |= (row[at >> 3] >> (7 - (at & 7)) & 1) == 0
        return proved

    for b in batches:
        single = one(b.column("k1"), b.column("k2")) & (b.column("depth").to_numpy() > 0)
        above = one(b.column("p1"), b.column("p2")) & (b.column("depth").to_numpy() > 1)
        yield pa.record_batch([*b.columns, pa.array(single), pa.array(above)], names=[*b.schema.names, "single", "above"])


# ---- ends


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation -> one SHA-256 per node, fed batch by batch."""
    node, sha = None, None
    for b in batches:
        k1, k2, conv = (b.column(c).to_numpy() for c in ("k1", "k2", "conv"))
        cut = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))) if len(k1) else []
        done = []
        for a, e in zip(cut, [*cut[1:], len(k1)]):
            now = (int(k1[a]), int(k2[a]))
            ids = ",".join(map(str, conv[a:e].tolist())).encode()
            if now == node:
                sha.update(b"," + ids)
                continue
            if node is not None:
                done.append((*node, sha.hexdigest()))
            node, sha = now, hashlib.sha256(ids)
        if done:
            yield _named(done)
    if node is not None:
        yield _named([(*node, sha.hexdigest())])


def _named(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch({"k1": pa.array([r[0] for r in rows], pa.int64()), "k2": pa.array([r[1] for r in rows], pa.int64()), "ends_sha256": pa.array([r[2] for r in rows], pa.string())})


# ---- the trie

EMPTY = hashlib.sha256(b"").hexdigest()
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(turns: DataFrame, lengths: DataFrame, cells: int | None = None) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, depth from 1, m: hash of the turn, bytes) of conversations with ``lengths`` (conv, len).

    conv_id: smallest member; depth; parent_conv_id: the parent's conv_id; n_convs: members; n_children; n_leaves: childless nodes of
    the subtree, itself included; saved_tokens: (members - 1) * bytes of the last turn over the subtree; ends_sha256: SHA-256 of the
    ids of members that end here, ascending, joined by commas. ``cells`` of a row of the sketch: a power of two from 8 on; by default
    eight for each prefix, as far as ``MOST_CELLS``.
    """
    spark = turns.sparkSession
    paths = stored(prefixes(turns, lengths), "prefixes")
    sketch = spark.sparkContext.broadcast(screen(paths.where("depth > 0"), cells or cells_for(paths.count())))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in paths.schema)
    rows = stored(paths.mapInArrow(lambda bs: _prove(bs, sketch), f"{fields}, single boolean, above boolean"), "screened")
    last = F.col("depth") == F.col("len")
    tails, maybe = rows.where("single"), rows.where("not single")

    key = ["k1", "k2"]
    nodes = stored(maybe.groupBy(*key).agg(F.min("conv").alias("rep"), F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n"), F.max("len").alias("longest"), F.first("bytes").alias("bytes"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("above").alias("above")), "nodes")

    own = nodes.select(F.col("rep").alias("conv"), "depth", ((F.col("n") - 1) * F.col("bytes")).alias("saves"), (F.col("longest") == F.col("depth")).cast("long").alias("leaf"))
    zero = F.lit(0).cast("long")
    marked = maybe.select("conv", "depth", *key).join(own, ["conv", "depth"], "left").select("conv", (-F.col("depth")).alias("up"), *key, F.coalesce("saves", zero).alias("saves"), F.coalesce("leaf", zero).alias("leaf"))
    ended = tails.where(last).select("conv", (-F.col("depth")).alias("up"), F.lit(None).cast("long").alias("k1"), F.lit(None).cast("long").alias("k2"), zero.alias("saves"), F.lit(1).cast("long").alias("leaf"))
    summed = ordered_scan(marked.unionByName(ended), ["conv"], ["up"], running={"below": "saves", "leaves": "leaf"}, spread_equal=False)
    subtree = summed.where("k1 is not null").groupBy(*key).agg(F.sum("below").cast("long").alias("saved_tokens"), F.sum("leaves").cast("long").alias("n_leaves"))

    first = tails.where("not above")
    children = nodes.where("p1 is not null and not above").select("p1", "p2").unionByName(first.select("p1", "p2")).groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_children"))
    children = children.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    ends = maybe.where(last).select(*key, "conv").repartition(*key).sortWithinPartitions(*key, "conv").mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")
    names = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("rep").alias("parent"))

    # a prefix that the screen did not prove may hang below a proved one: both belong to one conversation, which is the parent
    parent = F.when(F.col("above"), F.col("rep")).otherwise(F.col("parent"))
    shared = (
        nodes.join(names, ["p1", "p2"], "left").select(*key, F.col("rep").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"))
        .join(children, key, "left").join(subtree, key, "left").join(ends, key, "left")
    )
    shared = shared.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))

    alone = lambda df, parent: df.select(F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
                                         F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), F.when(last, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"))
    deeper = alone(tails.where("above"), F.col("conv"))
    top = alone(first.join(names, ["p1", "p2"], "left"), F.col("parent"))
    return shared.unionByName(top).unionByName(deeper)
