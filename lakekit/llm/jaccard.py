"""Texts whose sets of word shingles overlap: a size-aware heavy-light join, and the groups it forms.

Two documents are linked when 100 * |A and B| >= 85 * |A or B| over their sets of distinct 4-word shingles (64-bit hashes); a ``Rule``
gives other numbers. Documents
with one and the same set are one node, named by 64 bits; a second 64 bits tell different sets of one name apart, which then get other names. Sets of at most ``boundary`` shingles are light: for every pair of sizes that can be linked, the overlap needed
is a fixed number, so both sides enumerate their subsets of that size, and a shared subset is a link, with no pair formed or
checked. Larger sets are heavy: they scan inverted lists. A list holds the sets with a shingle among their first
``n - ceil(0.85 n) + 1`` (for that rule) in one common order; two linked sets meet in a list at least once. The boundary is the one with the least
cost, subsets enumerated below it against list entries above it, over the sizes that the corpus has.

The order puts frequent shingles last. Frequencies are counted over all documents: every task sorts its hashes and sends them as gaps
(four bytes each, eight where few hashes lie far apart) to the range of hashes they belong to. Shingles found more than ``T`` times are frequent; T is the least power of
two from 32 that leaves at most a million of them, so that they can be broadcast. Lists of other shingles hold at most T sets. Lists of frequent shingles are
reached only by sets that consist almost wholly of such; they may be of any length and are never gathered.

Only links that join groups matter for the result. So lists are first worked through by stars and chains (one or two candidates per
entry), then in up to two turns by two sets drawn from each group that has several in a list, against two of every other group there. This joins the members of large groups of near copies; after that, candidates are the pairs of a list that are still in
different groups. Candidates whose places in the order, or whose sketches of 1024 parities, rule a link out are dropped; the others
are checked exactly on their sets. No pair of a list is left out unless both are in one group by then.

NULL and empty texts and texts of white space have an empty set and are alone. Repeated rows and equal ids: every row gets its result, and equal
sets are linked. A NULL id is passed over when the smallest id of a group is taken. Extra columns are not read; an
empty table gives no rows. Sets are as long as their text; lists and groups have no limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix, pieces, runs, stored, word_hashes
from .graph import components



class Rule(NamedTuple):
    """Sets of shingles of so many words are linked when they share part / whole of their union."""

    words: int = 4
    part: int = 85
    whole: int = 100
    node_bits: int = 64  # of the number that names a set; fewer only to see different sets share one


RULE = Rule()
FREQUENT = 1 << 20
LEAST_FREQUENT = 32
BITS = 48  # of a hash, for counting
BATCH = 1 << 20  # bytes of text whose sets are made together
HELD = 1_000_000  # shingles that a task counts together
TURNS = 2  # of drawing sets from the groups of a list, at most
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def step(i: int) -> np.uint64:
    """The factor of the word at place i of a shingle."""
    return _STEP[i] if i < len(_STEP) else mix(np.array([i], np.uint64))[0] | np.uint64(1)


def overlap(r: int, s: int, rule: Rule = RULE) -> int:
    """Fewest shared shingles of two linked sets of these sizes."""
    return -(-rule.part * (r + s) // (rule.whole + rule.part))


def partners(n: int, rule: Rule = RULE) -> range:
    """Sizes that a set of n shingles can be linked with."""
    return range(-(-rule.part * n // rule.whole), rule.whole * n // rule.part + 1)


def prefix(n: int, rule: Rule = RULE) -> int:
    return n - -(-rule.part * n // rule.whole) + 1


def sets_of(col: pa.Array, words: int = RULE.words) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    h, row = word_hashes(col)
    ends = np.searchsorted(row, np.arange(len(col) + 1))
    grams = np.zeros(0, np.uint64)
    if len(h) >= words:
        last = len(h) - words + 1
        grams = mix(sum((h[i : i + last] * step(i) for i in range(1, words)), h[:last] * step(0)))
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= words:
            x = np.sort(grams[a : b - words + 1])
            out.append(x[runs(x)])
        elif b > a:
            x = h[a:b]
            out.append(mix(sum((x[i : i + 1] * step(i) for i in range(1, len(x))), x[:1] * step(0)) + np.uint64(len(x))))
        else:
            out.append(x := np.zeros(0, np.uint64))
    return out


def node_of(x: np.ndarray, rule: Rule = RULE) -> tuple[int, int]:
    """Two signatures of a set, 64 bits each; the first names it."""
    a, b = (int(mix(x * s).sum(dtype=np.uint64) + np.uint64(len(x))) for s in _STEP[:2])
    return _signed(a >> (64 - rule.node_bits)), _signed(b)


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


Moved = frozenset[tuple[int, int]]


def name_of(x: np.ndarray, rule: Rule, moved: Moved) -> int:
    """The name of a set; where different sets share their first signature, those in ``moved`` are named by both."""
    node, check = node_of(x, rule)
    return renamed(node, check) if moved and (node, check) in moved else node


def renamed(node: int, check: int) -> int:
    both = np.array([node, check], np.int64).view(np.uint64)
    return _signed(int(mix(mix(both[1:] + np.uint64(1)) ^ both[:1])[0]))


LANES = 16


def sketch_of(x: np.ndarray) -> np.ndarray:
    """1024 parities in 16 numbers: every shingle flips one. Two sets differ in at least as many shingles as their sketches in bits."""
    return np.packbits(np.bincount((mix(x ^ _STEP[3]) >> np.uint64(54)).astype(np.int64), minlength=64 * LANES).astype(np.uint8) & 1).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "text", BATCH):
        sets = sets_of(b.column("text"), rule.words)
        sig = [node_of(x, rule) for x in sets]
        yield pa.record_batch({"doc_id": b.column("doc_id"), "n": pa.array([len(x) for x in sets], pa.int64()), "node": pa.array([s[0] for s in sig], pa.int64()), "check": pa.array([s[1] for s in sig], pa.int64()), "sketch": pa.array([sketch_of(x) for x in sets], pa.list_(pa.int64()))})


# ---- frequent shingles


def _tally(batches: Iterator[pa.RecordBatch], buckets: int, rule: Rule) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for b in pieces(batches, "text", BATCH):
        for x in sets_of(b.column("text"), rule.words):
            held.append(x)
            size += len(x)
        if size > HELD:
            yield _gaps(held, buckets)
            held, size = [], 0
    if size:
        yield _gaps(held, buckets)


def _gaps(held: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Sorted hashes with their counts, by bucket; gaps of four bytes, or of eight in a bucket with a larger one."""
    v = np.sort(np.concatenate(held) >> np.uint64(64 - BITS))
    at = runs(v)
    v, n = v[at], np.diff(np.append(at, len(v)))
    if n.max() > 65535:  # a count beyond two bytes takes more entries
        times = (n - 1) // 65535 + 1
        last = np.cumsum(times) - 1
        left = n - 65535 * (times - 1)
        v, n = np.repeat(v, times), np.full(last[-1] + 1, 65535)
        n[last] = left
    n = n.astype(np.uint16)
    bucket = (v // np.uint64((1 << BITS) // buckets)).astype(np.int64)
    gap = np.concatenate(([0], np.diff(v.astype(np.int64))))
    cut = runs(bucket)
    gap[cut] = 0
    ends = np.append(cut[1:], len(v))
    short = lambda g: g.astype(np.uint32) if g.max() < 1 << 32 else g
    return pa.record_batch({"bucket": pa.array(bucket[cut], pa.int32()), "first": pa.array(v[cut].astype(np.int64)), "gaps": pa.array([short(gap[a:e]).tobytes() for a, e in zip(cut, ends)], pa.binary()), "counts": pa.array([n[a:e].tobytes() for a, e in zip(cut, ends)], pa.binary())})


def _frequent(group: pa.Table, least: int) -> pa.Table:
    v, n = [], []
    for first, gaps, counts in zip(group.column("first").to_pylist(), group.column("gaps").to_pylist(), group.column("counts").to_pylist()):
        n.append(np.frombuffer(counts, np.uint16).astype(np.int64))
        v.append(first + np.cumsum(np.frombuffer(gaps, np.uint32 if len(gaps) == 4 * len(n[-1]) else np.int64).astype(np.int64)))
    v, n = np.concatenate(v), np.concatenate(n)
    order = np.argsort(v, kind="stable")
    v, n = v[order], n[order]
    at = runs(v)
    total = np.add.reduceat(n, at)
    often = total > least
    return pa.table({"h": pa.array(v[at][often]), "n": pa.array(total[often])})


def frequent(docs: DataFrame, shingles: int, least: int = LEAST_FREQUENT, most: int = FREQUENT, rule: Rule = RULE) -> np.ndarray:
    """The shingles (their leading bits) found in more than T documents, T the least power of two that leaves at most ``most`` of them."""
    buckets = 1 << max(5, (shingles >> 20).bit_length())
    packed = docs.mapInArrow(lambda bs: _tally(bs, buckets, rule), "bucket int, first long, gaps binary, counts binary")
    often = stored(packed.groupBy("bucket").applyInArrow(lambda g: _frequent(g, least), "h long, n long"), "frequent")
    by_power = {r.p: r.k for r in often.groupBy(F.floor(F.log2(F.col("n") - 1)).alias("p")).agg(F.count(F.lit(1)).alias("k")).collect()}  # at most 64 rows
    power = least.bit_length() - 1
    while sum(k for p, k in by_power.items() if p >= power) > most:
        power += 1
    return np.sort(often.where(F.col("n") > (1 << power)).select("h").toArrow().column("h").to_numpy().astype(np.uint64))


# ---- light sets: subsets; heavy sets: inverted lists


def boundary(sizes: dict[int, int], most: int = 64, rule: Rule = RULE) -> int:
    """The largest light size with the least cost; an entry of a list is counted, read, paired and checked, and weighs as sixteen subsets."""
    light = lambda n, top: sum(math.comb(n, overlap(n, m, rule)) for m in partners(n, rule) if m <= top)
    best, found = 0, math.inf
    for top in range(0, 31):
        cost = sum(k * light(n, top) for n, k in sizes.items() if n <= top) + sum(16 * k * prefix(n, rule) for n, k in sizes.items() if n <= most and n >= -(-rule.part * (top + 1) // rule.whole))
        if cost < found:
            best, found = top, cost
    return best


def subsets(x: np.ndarray, m: int, rule: Rule = RULE) -> np.ndarray:
    """Keys of all subsets that a set of m shingles must share one of to be linked; sums of hashes, less those left out."""
    n = len(x)
    h = mix(x + np.uint64(0x51ED2701))
    total = h.sum(dtype=np.uint64)
    left = n - overlap(n, m, rule)
    sums = np.array([total], np.uint64) if left == 0 else total - np.array([h[list(c)].sum(dtype=np.uint64) for c in combinations(range(n), left)], np.uint64)
    return mix(sums + mix(np.array([min(n, m) << 32 | max(n, m)], np.uint64)))


def in_order(x: np.ndarray, often: np.ndarray, rule: Rule = RULE) -> tuple[np.ndarray, int]:
    """The first shingles of a set in the common order, and how many of them are not frequent."""
    p = prefix(len(x), rule)
    if len(often):
        v = x >> np.uint64(64 - BITS)
        at = np.minimum(np.searchsorted(often, v), len(often) - 1)
        hot = often[at] == v
        rare = x[~hot][:p]
        return np.concatenate([rare, x[hot][: p - len(rare)]]), len(rare)
    return x[:p], p


def _cold(batches: Iterator[pa.RecordBatch], often: np.ndarray, top: int, buckets: int, rule: Rule, moved: Moved) -> Iterator[pa.RecordBatch]:
    """Entries of the lists of shingles that are not frequent, packed by range of hashes."""
    low = -(-rule.part * (top + 1) // rule.whole)
    held: list[tuple] = []
    size = 0
    seen: set[int] = set()
    for b in pieces(batches, "text", BATCH):
        for x in sets_of(b.column("text"), rule.words):
            if len(x) < low:
                continue
            first, rare = in_order(x, often, rule)
            node = name_of(x, rule, moved)
            if rare and node not in seen:
                seen.add(node)
                held.append((first[:rare], node, len(x)))
                size += rare
        if size > 1_000_000:
            yield _entries(held, buckets)
            held, size, seen = [], 0, set()
    if size:
        yield _entries(held, buckets)


def _entries(held: list[tuple], buckets: int) -> pa.RecordBatch:
    h = np.concatenate([x[0] for x in held])
    times = [len(x[0]) for x in held]
    node, n = np.repeat(np.array([x[1] for x in held], np.int64), times), np.repeat(np.array([x[2] for x in held], np.int32), times)
    place = np.concatenate([np.arange(t, dtype=np.int32) for t in times])
    order = np.argsort(h)
    h, node, n, place = h[order], node[order], n[order], place[order]
    bucket = (h // np.uint64((1 << 64) // buckets)).astype(np.int64)
    cut = runs(bucket)
    ends = np.append(cut[1:], len(h))
    blobs = lambda a: pa.array([a[i:e].tobytes() for i, e in zip(cut, ends)], pa.binary())
    return pa.record_batch({"bucket": pa.array(bucket[cut], pa.int32()), "h": blobs(h), "node": blobs(node), "n": blobs(n), "place": blobs(place)})


def _lists(group: pa.Table) -> pa.Table:
    """Entries of lists with two sets or more."""
    join = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in group.column(c).to_pylist()])
    h, node, n, place = join("h", np.uint64), join("node", np.int64), join("n", np.int32), join("place", np.int32)
    order = np.lexsort((node, h))
    h, node, n, place = h[order], node[order], n[order], place[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (node[1:] != node[:-1])))
    h, node, n, place = h[new], node[new], n[new], place[new]
    at = runs(h)
    many = np.repeat(np.diff(np.append(at, len(h))), np.diff(np.append(at, len(h)))) > 1
    return pa.table({"h": pa.array(h[many].view(np.int64)), "node": pa.array(node[many]), "n": pa.array(n[many].astype(np.int64)), "place": pa.array(place[many].astype(np.int64))})


def _hot_and_light(batches: Iterator[pa.RecordBatch], often: np.ndarray, top: int, rule: Rule, moved: Moved) -> Iterator[pa.RecordBatch]:
    """Rows for frequent shingles (other = 0) and for the subsets of light sets (other: the size of the partner)."""
    low = -(-rule.part * (top + 1) // rule.whole)
    seen: set[int] = set()
    for b in pieces(batches, "text", BATCH):
        keys, nodes, sizes, others, places = [], [], [], [], []
        for x in sets_of(b.column("text"), rule.words):
            if not len(x):
                continue
            got: list[tuple[np.ndarray, int]] = []
            if len(x) <= top:
                got += [(subsets(x, m, rule), m) for m in partners(len(x), rule) if m <= top]
            if len(x) >= low:
                first, rare = in_order(x, often, rule)
                if rare < len(first):
                    got.append((first[rare:], 0))
            if got and (node := name_of(x, rule, moved)) not in seen:
                seen.add(node)
                for k, m in got:
                    keys.append(k)
                    nodes += [node] * len(k)
                    sizes += [len(x)] * len(k)
                    others += [m] * len(k)
                    places += range(len(k)) if m else range(rare, rare + len(k))
        if len(seen) > 1_000_000:
            seen = set()
        if keys:
            yield pa.record_batch({"h": pa.array(np.concatenate(keys).view(np.int64)), "node": pa.array(nodes, pa.int64()), "n": pa.array(sizes, pa.int64()), "other": pa.array(others, pa.int64()), "place": pa.array(places, pa.int64())})


def fits(r: str, s: str, i: str, j: str, rule: Rule):
    """Sizes that can be linked, and places in the two orders that the first shared shingle of linked sets can have: with
    o shared ones, at most r - o come before it."""
    o = F.expr(f"div({rule.part} * ({r} + {s}) + {rule.whole + rule.part - 1}, {rule.whole + rule.part})")
    return (rule.whole * F.least(r, s) >= rule.part * F.greatest(r, s)) & (F.col(i) <= F.col(r) - o) & (F.col(j) <= F.col(s) - o)


def not_ruled_out(r: str, s: str, x: str, y: str, rule: Rule):
    """Sketches differ in no more bits than linked sets of these sizes may differ in shingles, (whole - part) (r + s) / (whole + part)."""
    bits = sum((F.bit_count(F.col(f"{x}{k}").bitwiseXOR(F.col(f"{y}{k}"))) for k in range(1, LANES)), F.bit_count(F.col(f"{x}0").bitwiseXOR(F.col(f"{y}0"))))
    return (rule.whole + rule.part) * bits <= (rule.whole - rule.part) * (F.col(r) + F.col(s))


def lanes(name: str):
    return [F.col("sketch")[k].alias(f"{name}{k}") for k in range(LANES)]


def _pairs_of(group: pa.Table, rule: Rule) -> pa.Table:
    """Neighbours in a list by size, and every set with the middle one: at most two candidates per entry."""
    h, node, n, place = (group.column(c).to_numpy() for c in ("h", "node", "n", "place"))
    order = np.lexsort((node, n, h))
    h, node, n, place = h[order], node[order], n[order], place[order]
    at = runs(h)
    size = np.diff(np.append(at, len(h)))
    middle = np.repeat(at + size // 2, size)
    every = np.arange(len(h))
    a = np.concatenate([every[:-1][h[1:] == h[:-1]], every])
    b = np.concatenate([every[1:][h[1:] == h[:-1]], middle])
    x, y = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
    shared = -(-rule.part * (n[a] + n[b]) // (rule.whole + rule.part))
    good = (x != y) & (rule.whole * np.minimum(n[a], n[b]) >= rule.part * np.maximum(n[a], n[b])) & (place[a] <= n[a] - shared) & (place[b] <= n[b] - shared)
    both = np.stack([x[good], y[good]], 1)
    if len(both):
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        both = both[np.concatenate(([True], (both[1:] != both[:-1]).any(1)))]
    return pa.table({"a": pa.array(both[:, 0] if len(both) else np.zeros(0, np.int64)), "b": pa.array(both[:, 1] if len(both) else np.zeros(0, np.int64))})


def _sets(batches: Iterator[pa.RecordBatch], rule: Rule, moved: Moved) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "text", BATCH):
        sets = sets_of(b.column("text"), rule.words)
        yield pa.record_batch({"node": pa.array([name_of(x, rule, moved) for x in sets], pa.int64()), "set": pa.array([x.tobytes() for x in sets], pa.binary())})


def _linked(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column("x"), b.column("y")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            keep.append(rule.whole * shared >= rule.part * (len(x) + len(y) - shared))
        yield pa.record_batch([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


class Join:
    """The steps of the join over one table of documents."""

    def __init__(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = RULE):
        self.rule = rule
        self.docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
        self.rows = stored(self.docs.mapInArrow(lambda bs: _signatures(bs, rule), f"doc_id {self.docs.schema['doc_id'].dataType.simpleString()}, n long, node long, check long, sketch array<long>"), "signatures")
        self.moved: Moved = frozenset()
        self.nodes = self._nodes()
        if (clash := self.nodes.where("check <> other").select(F.col("node").alias("k"), "check")).count():
            # different sets with one name: all but one of them get another name; some ten pairs among 2e10 documents
            again = self.rows.where("n > 0").join(clash.withColumnRenamed("check", "first"), F.col("node") == F.col("k")).where("check <> first").select("node", "check").distinct()
            self.moved = frozenset((r.node, r.check) for r in again.collect())
            names = docs.sparkSession.createDataFrame([(*m, renamed(*m)) for m in self.moved], "k long, c long, name long")
            at = self.rows.join(names, (F.col("node") == F.col("k")) & (F.col("check") == F.col("c")) & (F.col("n") > 0), "left")
            self.rows = stored(at.select("doc_id", "n", F.coalesce("name", "node").alias("node"), "check", "sketch"), "signatures")
            self.nodes = self._nodes()

    def _nodes(self) -> DataFrame:
        own = self.rows.where("n > 0").groupBy("node")
        return stored(own.agg(F.min("doc_id").alias("doc"), F.max("n").alias("n"), F.first("sketch").alias("sketch"), F.min("check").alias("check"), F.max("check").alias("other")), "nodes")

    def lists(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(h, node, n) of the lists of other, and of frequent shingles, with two sets or more; links between light sets."""
        sizes = {r.n: r["count"] for r in self.rows.where("n between 1 and 64").groupBy("n").count().collect()}
        total = self.rows.agg(F.sum("n")).first()[0] or 0
        rule, moved = self.rule, self.moved
        top = boundary(sizes, rule=rule)
        sent = self.docs.sparkSession.sparkContext.broadcast(frequent(self.docs, total, rule=rule))
        buckets = 1 << max(5, (total >> 21).bit_length())
        packed = self.docs.mapInArrow(lambda bs: _cold(bs, sent.value, top, buckets, rule, moved), "bucket int, h binary, node binary, n binary, place binary")
        cold = stored(packed.groupBy("bucket").applyInArrow(_lists, "h long, node long, n long, place long"), "lists")
        rest = stored(self.docs.mapInArrow(lambda bs: _hot_and_light(bs, sent.value, top, rule, moved), "h long, node long, n long, other long, place long"), "lists")
        ends = rest.where("other = 0").groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
        hot = rest.where("other = 0").join(ends.select(F.col("h").alias("k")), F.col("h") == F.col("k")).select("h", "node", "n", "place")
        light = rest.where("other > 0")
        hub = light.groupBy("h").agg(F.min(F.when(F.col("n") <= F.col("other"), F.col("node"))).alias("lo"), F.min(F.when(F.col("n") >= F.col("other"), F.col("node"))).alias("hi")).withColumnRenamed("h", "k")
        links = light.join(hub, F.col("h") == F.col("k")).select(F.col("node").alias("a"), F.when(F.col("n") < F.col("other"), F.col("hi")).otherwise(F.col("lo")).alias("b")).where("a <> b")
        return cold, stored(hot, "lists"), links

    def check(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are linked: first by their sketches, then on their sets."""
        side = lambda k, n, x: self.nodes.select(F.col("node").alias(f"_{k}"), F.col("n").alias(n), *lanes(x))
        near = pairs.distinct().join(side("a", "r", "x"), F.col("a") == F.col("_a")).join(side("b", "s", "y"), F.col("b") == F.col("_b"))
        return self.verify(near.where(not_ruled_out("r", "s", "x", "y", self.rule)).select("a", "b"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are linked on their sets. Only sets that stand in a pair are made, each once."""
        rule, moved = self.rule, self.moved
        pairs = stored(pairs.distinct(), "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
        ids = stored(self.nodes.join(wanted, F.col("node") == F.col("k")).select(F.col("doc").alias("id")).distinct(), "wanted")
        few = ids.count() <= 1 << 20  # 16 MB at most
        near = self.docs.join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
        # a shared id can bring other sets along; they meet no pair, and equal sets are kept once
        sets = near.mapInArrow(lambda bs: _sets(bs, rule, moved), "node long, set binary").dropDuplicates(["node"])
        x = sets.select(F.col("node").alias("na"), F.col("set").alias("x"))
        y = sets.select(F.col("node").alias("nb"), F.col("set").alias("y"))
        both = pairs.join(x, F.col("a") == F.col("na")).join(y, F.col("b") == F.col("nb")).select("a", "b", "x", "y")
        return stored(both.mapInArrow(lambda bs: _linked(bs, rule), "a long, b long"), "links")

    def roots(self) -> DataFrame:
        """node, root for every node with a link."""
        rule = self.rule
        cold, hot, links = self.lists()
        buckets = max(32, cold.count() >> 18)
        first = cold.withColumn("_b", F.pmod(F.xxhash64("h"), F.lit(buckets))).groupBy("_b").applyInArrow(lambda g: _pairs_of(g.select(["h", "node", "n", "place"]), rule), "a long, b long")
        one = F.struct("node", "n", "place")
        ends = hot.groupBy("h").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).withColumnRenamed("h", "k")
        star = hot.join(ends, F.col("h") == F.col("k")).select("node", "n", "place", F.explode(F.array("lo", "hi")).alias("e")).where(F.col("node") != F.col("e.node")).where(fits("n", "e.n", "place", "e.place", rule))
        star = star.select(F.least("node", "e.node").alias("a"), F.greatest("node", "e.node").alias("b"))
        links = stored(links.unionByName(self.check(first.unionByName(star))), "links")
        lists = self._open(cold.unionByName(hot), components(links))
        for turn in range(TURNS):
            met = self.verify(self._met(lists, turn))
            if met.isEmpty():
                break
            links = stored(links.unionByName(met), "links")
            lists = self._open(lists, components(links))
        return components(links.unionByName(self.verify(self._apart(lists))))

    def _open(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """The entries, with group and sketch, of lists whose sets are not all in one group."""
        rule = self.rule
        e = lists.select("h", "node", "n", "place")
        e = e.join(roots.withColumnRenamed("node", "v"), F.col("node") == F.col("v"), "left").select("h", "node", "n", "place", F.coalesce("root", "node").alias("root"))
        e = stored(e, "lists")
        open_ = e.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select(F.col("h").alias("k"))
        e = e.join(open_, F.col("h") == F.col("k")).select("h", "node", "n", "place", "root")
        # in a list, a set can meet another one only if it is near enough to its start for a partner of some size
        e = e.where(f"place <= n - div({rule.part} * n + {rule.whole - 1}, {rule.whole})")
        sketches = self.nodes.select(F.col("node").alias("v"), *lanes("x"))
        return stored(e.join(sketches, F.col("node") == F.col("v")).drop("v"), "lists")

    def _met(self, e: DataFrame, turn: int) -> DataFrame:
        """Pairs between two sets of every group in a list and two of every other one, drawn by a hash; one of both groups has several
        sets there. However many sets of two groups meet in a list, they make four pairs at most; other lists and turns draw others."""
        rule = self.rule
        own = F.struct(F.xxhash64(F.lit(turn), "h", "node").alias("d"), "node", "n", "place", *[f"x{k}" for k in range(LANES)])
        drawn = e.groupBy("h", "root").agg(F.count(F.lit(1)).alias("c"), F.min(own).alias("lo"), F.max(own).alias("hi"))
        drawn = drawn.select("h", "root", "c", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("o")).select("h", "root", "c", "o.*").drop("d")
        o = drawn.toDF("h2", "root2", "c2", "node2", "n2", "place2", *[f"y{k}" for k in range(LANES)])
        several = (F.col("c") > 1) & ((F.col("c2") == 1) | (F.col("root") < F.col("root2")))
        pairs = drawn.join(o, (F.col("h") == F.col("h2")) & (F.col("root") != F.col("root2")) & several & fits("n", "n2", "place", "place2", rule) & not_ruled_out("n", "n2", "x", "y", rule))
        return pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))

    def _apart(self, e: DataFrame) -> DataFrame:
        """The pairs of every list whose sets are not in one group yet and not ruled out by places or sketches; what is
        ruled out never leaves the join."""
        rule = self.rule
        o = e.toDF("h2", "node2", "n2", "place2", "root2", *[f"y{k}" for k in range(LANES)])
        pairs = e.join(o, (F.col("h") == F.col("h2")) & (F.col("node") < F.col("node2")) & (F.col("root") != F.col("root2")) & fits("n", "n2", "place", "place2", rule) & not_ruled_out("n", "n2", "x", "y", rule))
        return pairs.select(F.col("node").alias("a"), F.col("node2").alias("b"))

    def named(self) -> DataFrame:
        """node, root, and the smallest id of the node, for every node."""
        roots = self.roots().withColumnsRenamed({"node": "v"})
        return stored(self.nodes.join(roots, F.col("node") == F.col("v"), "left").select("node", "doc", F.coalesce("root", "node").alias("root")), "roots")

    def groups(self) -> DataFrame:
        """doc_id, n_shingles, component_id for every row."""
        named = self.named()
        least = named.groupBy("root").agg(F.min("doc").alias("least")).withColumnRenamed("root", "r")
        ids = named.join(least, F.col("root") == F.col("r")).select(F.col("node").alias("v"), "least")
        out = self.rows.join(ids, (F.col("node") == F.col("v")) & (F.col("n") > 0), "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = RULE) -> DataFrame:
    return Join(docs, text, doc_id, rule).groups()


def _tagged(batches: Iterator[pa.RecordBatch], rule: Rule, moved: Moved) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "text", BATCH):
        sets = sets_of(b.column("text"), rule.words)
        yield pa.record_batch([*b.columns, pa.array([len(x) for x in sets], pa.int64()), pa.array([name_of(x, rule, moved) for x in sets], pa.int64())], names=[*b.schema.names, "_n", "_node"])


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = RULE) -> DataFrame:
    """The documents with all their columns, less all but one of every group: the one with the smallest id stays (NULL comes last).

    Texts are not shuffled: rows are told by their id, and those to drop are taken out by an anti join. Rows whose id is NULL or repeated
    are told by id and set instead; of rows equal in both, any one stays. Documents without words all stay.
    """
    names = docs.columns
    plain = docs.toDF(*["text" if n == text else "doc_id" if n == doc_id else f"c{i}" for i, n in enumerate(names)])
    join = Join(plain, rule=rule)
    best = join.rows.where("n > 0").select("doc_id", F.col("node").alias("k")).distinct()
    named = join.named().select("node", "root")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")
    best = best.join(named, F.col("k") == F.col("node")).groupBy("root").agg(F.min(place).alias("b")).select(F.col("b.doc_id").alias("bid"), F.col("b.k").alias("bnode"))
    best = stored(best, "kept")
    many = stored(join.rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias("mid")), "repeated")
    mine = (F.col("doc_id").eqNullSafe(F.col("bid"))) & (F.col("node") == F.col("bnode"))
    lost = join.rows.where("n > 0").join(best, mine, "left_anti").select(F.col("doc_id").alias("gone")).union(many.select("mid"))
    lost = stored(lost.distinct(), "lost")
    few = lost.count() <= 1 << 20  # 16 MB at most
    out = plain.join(F.broadcast(lost) if few else lost, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti")
    if many.count():
        again = plain.join(many, F.col("doc_id").eqNullSafe(F.col("mid")), "left_semi")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in again.schema.fields)
        moved = join.moved
        again = again.mapInArrow(lambda bs: _tagged(bs, rule, moved), f"{ddl}, _n long, _node long")
        stay = again.join(best, F.col("doc_id").eqNullSafe(F.col("bid")) & (F.col("_node") == F.col("bnode")), "left_semi").dropDuplicates(["doc_id", "_node"])
        out = out.unionByName(stay.where("_n > 0").drop("_n", "_node")).unionByName(again.where("_n = 0").drop("_n", "_node"))
    return out.toDF(*names)
