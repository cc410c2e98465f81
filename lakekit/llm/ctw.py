"""Language model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes and an end byte 0; before it stand zeros. A byte is eight binary decisions down a tree of 255 nodes. For every node and
every context of 0 to ``depth`` preceding bytes a Krichevsky-Trofimov estimator counts the decisions seen in training; contexts of all depths are mixed with the weights
that the training texts give them (the weighted probability of a context is half its own estimate and half the
product of its extensions' weighted probabilities). The score of a text is the sum of log10 of the mixed probabilities, the model being
that of all training texts; its code length per byte follows.

Everything hangs on the counts of (context, byte) grams, so that is what moves. Documents are dealt to blocks of about ``block_bytes``; a block
lists its distinct grams and words with their training counts. Counts of one range of keys are merged over the blocks in
groups of at most 64, level by level; a range of grams holds whole subtrees below two bytes of context. The nodes of depth 0 and 1 (at most 65,280 numbers each)
are summed up on the driver and broadcast: a fixed bound. Every range answers the grams of every block, a block gets its answers
back and scores its texts. So neither a task nor the driver ever holds the model of the whole corpus.

The base score is that of add-one smoothed words: words with A-Z lower-cased and one end per text, by 64-bit hash.

NULL text is empty: one end, scored as such. Without training texts every decision has probability 1/2 and no word is known. Repeated
rows count, and are scored, each for itself; documents that share an id share a block. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix, pieces, runs, stored, text_bytes, word_hashes

DEPTH = 4
LN2 = float(np.log(2))
BLOCK = 16 << 20
MERGE = 64
PIECE = 2 << 20


def grams(col: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, offsets): the nearest byte of the context is the highest, the byte itself the lowest; every row has its bytes and an end."""
    data, off = text_bytes(col)
    row = np.repeat(np.arange(len(col)), np.diff(off))
    x = np.zeros(len(data) + len(col) * (depth + 1), np.uint64)
    x[np.arange(len(data)) + row * (depth + 1) + depth] = data
    ends = off + np.arange(len(off))
    at = np.arange(ends[-1]) + np.repeat(np.arange(len(col)) * depth, np.diff(ends)) + depth
    g = x[at]
    for k in range(1, depth + 1):
        g |= x[at - k] << np.uint64(8 * (depth - k + 1))
    return g, ends


def tally(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    at = runs(keys)
    return keys[at], np.add.reduceat(weights[order], at) if len(at) else weights


# ---- documents in blocks


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for b in pieces(batches, "text"):
        held.append(b)
        size += b.get_total_buffer_size() if b.num_rows == 0 else int(text_bytes(b.column("text"))[1][-1]) + 32 * b.num_rows
        if size > 32 << 20:
            yield _parcels(held)
            held, size = [], 0
    if held:
        yield _parcels(held)


def _parcels(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Rows of a block as one compressed value."""
    t = pa.Table.from_batches(held)
    blocks = t.column("block").to_numpy()
    order = np.argsort(blocks, kind="stable")
    at = runs(blocks[order])
    out = []
    for a, e in zip(at, np.append(at[1:], len(blocks))):
        sink = pa.BufferOutputStream()
        part = t.take(pa.array(order[a:e])).drop_columns(["block"])
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(part)
        out.append(sink.getvalue().to_pybytes())
    return pa.record_batch({"block": pa.array(blocks[order][at], pa.int32()), "data": pa.array(out, pa.binary())})


def _unpack(parcels: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
    for p in parcels:
        yield from pieces(pa.ipc.open_stream(p.as_buffer()), "text", PIECE)


# ---- what a block asks for


def _asks(group: pa.Table, depth: int, ranges: int) -> pa.Table:
    """(range, block, keys, counts): distinct grams and words of a block with their training counts; grams have ranges from ``ranges`` on."""
    held: tuple[list, list] = ([], [])
    for b in _unpack(group.column("data")):
        train = ~b.column("held_out").to_numpy(zero_copy_only=False)
        g, ends = grams(b.column("text"), depth)
        held[0].append(tally(g, np.repeat(train, np.diff(ends)).astype(np.int64)))
        h, row = word_hashes(b.column("text"))
        held[1].append(tally(h, train[row].astype(np.int64)))
    block = group.column("block")[0].as_py()
    rows: list[tuple] = []
    for kind, parts in enumerate(held):
        keys, n = tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        r = _range(keys, depth, ranges, kind)
        order = np.argsort(r, kind="stable")
        at = runs(r[order])
        for a, e in zip(at, np.append(at[1:], len(r))):
            i = order[a:e]
            rows.append((int(r[i[0]]), block, keys[i].tobytes(), n[i].tobytes()))
    return pa.table({"r": pa.array([x[0] for x in rows], pa.int32()), "block": pa.array([x[1] for x in rows], pa.int32()), "keys": pa.array([x[2] for x in rows], pa.binary()), "n": pa.array([x[3] for x in rows], pa.binary())})


def _range(keys: np.ndarray, depth: int, ranges: int, kind: int) -> np.ndarray:
    if kind:
        return (keys % np.uint64(ranges)).astype(np.int64)
    return ranges + (mix(keys >> np.uint64(8 * (depth - 1))) % np.uint64(ranges)).astype(np.int64)


def _merge(group: pa.Table) -> pa.Table:
    both = [np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(c)]) for c, kind in (("keys", np.uint64), ("n", np.int64))]
    keys, n = tally(*both)
    return pa.table({"r": group.column("r")[:1], "block": pa.array([group.column("block")[0].as_py() // MERGE], pa.int32()), "keys": pa.array([keys.tobytes()], pa.binary()), "n": pa.array([n.tobytes()], pa.binary())})


# ---- the tree


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    small = np.arange(1 << 16)
    return np.array([lgamma(i + 0.5) for i in small]), np.array([lgamma(i + 1.0) for i in small])


def _log_gamma(n: np.ndarray, half: bool) -> np.ndarray:
    """log gamma(n + 1/2) or (n + 1); by Stirling's series for large n."""
    table = _tables()[0 if half else 1]
    x = n + (0.5 if half else 1.0)
    big = n >= len(table)
    out = table[np.where(big, 0, n).astype(np.int64)]
    if big.any():
        y = x[big]
        out[big] = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3)
    return out


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(zeros, True) + _log_gamma(ones, True) - np.log(np.pi) - _log_gamma(zeros + ones, False)


def _subtrees(keys: np.ndarray, n: np.ndarray, depth: int, bit: int) -> dict:
    """Nodes of the contexts of 2 to ``depth`` bytes for the decision ``bit``: per depth the place of every gram, counts and log probabilities."""
    byte = (keys & np.uint64(255)).astype(np.int64)
    node = (1 << bit) | (byte >> (8 - bit))
    one = (byte >> (7 - bit)) & 1
    place, zeros, ones, weighted, own = {}, {}, {}, {}, {}
    first: dict[int, np.ndarray] = {}
    for d in range(2, depth + 1):
        context = (keys >> np.uint64(8 * (depth - d + 1))).astype(np.int64)
        key = context * 256 + node if d < 7 else runs_of(context) * 256 + node
        order = np.argsort(key, kind="stable")
        at = runs(key[order])
        place[d] = np.empty(len(keys), np.int64)
        place[d][order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(keys))))
        first[d] = order[at]
        size = len(at)
        ones[d] = np.bincount(place[d], n * one, size)
        zeros[d] = np.bincount(place[d], n * (1 - one), size)
        own[d] = estimate(zeros[d], ones[d])
    weighted[depth] = own[depth]
    for d in range(depth - 1, 1, -1):
        below = np.bincount(place[d][first[d + 1]], weighted[d + 1], len(own[d]))
        weighted[d] = np.logaddexp(own[d], below) - LN2
    return {"node": node, "one": one, "place": place, "zeros": zeros, "ones": ones, "own": own, "weighted": weighted, "first": first}


def runs_of(a: np.ndarray) -> np.ndarray:
    """Equal neighbours numbered; the contexts of sorted grams are sorted."""
    return np.cumsum(np.concatenate(([0], a[1:] != a[:-1])))


def _tops(batches: Iterator[pa.RecordBatch], depth: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """Sums over the contexts of two bytes for every (nearest byte, node); for ranges of words (-1) the distinct words and tokens of training."""
    for b in batches:
        for r, k, m in zip(b.column("r").to_pylist(), b.column("keys"), b.column("n")):
            keys, n = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(m.as_buffer(), np.int64)
            if r < ranges:
                yield pa.record_batch({"c": pa.array([-1], pa.int32()), "node": pa.array([0], pa.int32()), "zeros": pa.array([float((n > 0).sum())]), "ones": pa.array([float(n.sum())]), "w": pa.array([0.0])})
                continue
            for bit in range(8):
                t = _subtrees(keys, n, depth, bit)
                i = t["first"][2]
                c = (keys[i] >> np.uint64(8 * depth)).astype(np.int64)
                key = c * 256 + t["node"][i]
                order = np.argsort(key, kind="stable")
                at = runs(key[order])
                add = lambda x: np.add.reduceat(x[order], at)
                yield pa.record_batch({"c": pa.array(key[order][at] >> 8, pa.int32()), "node": pa.array(key[order][at] & 255, pa.int32()), "zeros": pa.array(add(t["zeros"][2])), "ones": pa.array(add(t["ones"][2])), "w": pa.array(add(t["weighted"][2]))})


def tops(rows: pa.Table) -> dict:
    """Weights of the estimators of depth 0 and 1, and their estimates of a one, from the sums over depth 2."""
    c, node, zeros, ones, w = (rows.column(x).to_numpy() for x in ("c", "node", "zeros", "ones", "w"))
    at = c * 256 + node
    z1, o1 = np.zeros(65536), np.zeros(65536)
    np.add.at(z1, at, zeros)
    np.add.at(o1, at, ones)
    below = np.zeros(65536)
    np.add.at(below, at, w)
    own1 = estimate(z1, o1)
    w1 = np.logaddexp(own1, below) - LN2
    z0, o0 = z1.reshape(256, 256).sum(0), o1.reshape(256, 256).sum(0)
    own0 = estimate(z0, o0)
    w0 = np.logaddexp(own0, np.where((z1 + o1).reshape(256, 256) > 0, w1.reshape(256, 256), 0).sum(0)) - LN2
    return {"stop1": np.exp(own1 - LN2 - w1), "one1": (o1 + 0.5) / (z1 + o1 + 1), "stop0": np.exp(own0 - LN2 - w0), "one0": (o0 + 0.5) / (z0 + o0 + 1)}


def log10_of(keys: np.ndarray, n: np.ndarray, depth: int, top: dict) -> np.ndarray:
    """log10 of the mixed probability of the byte of every gram."""
    out = np.zeros(len(keys))
    near = (keys >> np.uint64(8 * depth)).astype(np.int64)
    for bit in range(8):
        t = _subtrees(keys, n, depth, bit)
        p = None
        for d in range(depth, 1, -1):
            i = t["place"][d]
            kt = ((t["ones"][d] + 0.5) / (t["ones"][d] + t["zeros"][d] + 1))[i]
            if p is None:
                p = kt
            else:
                stop = np.exp(t["own"][d] - LN2 - t["weighted"][d])[i]
                p = stop * kt + (1 - stop) * p
        at = near * 256 + t["node"]
        p = top["stop1"][at] * top["one1"][at] + (1 - top["stop1"][at]) * p
        p = top["stop0"][t["node"]] * top["one0"][t["node"]] + (1 - top["stop0"][t["node"]]) * p
        out += np.log10(np.where(t["one"] == 1, p, 1 - p))
    return out


def _model(batches: Iterator[pa.RecordBatch], depth: int, ranges: int, top: dict) -> Iterator[pa.RecordBatch]:
    """The values of a range: log10 probabilities of grams, training counts of words."""
    for b in batches:
        for r, k, m in zip(b.column("r").to_pylist(), b.column("keys"), b.column("n")):
            keys, n = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(m.as_buffer(), np.int64)
            values = n.astype(np.float64) if r < ranges else log10_of(keys, n, depth, top)
            yield pa.record_batch({"mr": pa.array([r], pa.int32()), "all": pa.array([k.as_py()], pa.binary()), "values": pa.array([values.tobytes()], pa.binary())})


def _answers(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r, block, k, a, v in zip(b.column("r").to_pylist(), b.column("block").to_pylist(), b.column("keys"), b.column("all"), b.column("values")):
            keys, every, values = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(v.as_buffer(), np.float64)
            got = values[np.searchsorted(every, keys)]
            yield pa.record_batch({"block": pa.array([block], pa.int32()), "words": pa.array([r < ranges]), "keys": pa.array([k.as_py()], pa.binary()), "values": pa.array([got.tobytes()], pa.binary())})


def _scores(docs: pa.Table, answers: pa.Table, depth: int, known: tuple[int, int, int], schema: pa.Schema) -> pa.Table:
    """Scores of a block's texts. known: training tokens, distinct tokens, ends."""
    total, distinct, ends_seen = known
    tables = []
    for words in (False, True):
        part = answers.filter(pa.array([x == words for x in answers.column("words").to_pylist()], pa.bool_()))
        keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("keys"))])
        values = np.concatenate([np.zeros(0), *(np.frombuffer(x.as_buffer(), np.float64) for x in part.column("values"))])
        order = np.argsort(keys)
        tables.append((keys[order], values[order]))
    (gkeys, gvalues), (wkeys, wvalues) = tables
    base = np.log10(total + distinct + 1.0)
    out = []
    for b in _unpack(docs.column("data")):
        g, ends = grams(b.column("text"), depth)
        score = np.add.reduceat(gvalues[np.searchsorted(gkeys, g)], ends[:-1])
        h, row = word_hashes(b.column("text"))
        c = wvalues[np.searchsorted(wkeys, h)] if len(h) else np.zeros(0)
        n = np.bincount(row, minlength=b.num_rows) + 1
        hit = np.bincount(row, c > 0, b.num_rows) + (ends_seen > 0)
        logs = np.bincount(row, np.log10(c + 1) - base, b.num_rows) + (np.log10(ends_seen + 1) - base)
        out.append(pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(n, pa.int64()), pa.array(hit.astype(np.int64)), pa.array(np.full(b.num_rows, total, np.int64)), pa.array(logs), pa.array(score), pa.array(-score / np.log10(2) / np.diff(ends))], schema=schema))
    return pa.Table.from_batches(out, schema)


def score(docs: DataFrame, held_out, text: str = "text", doc_id: str = "doc_id", depth: int = DEPTH, block_bytes: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte (of the bytes and the end) for every row;
    rows where ``held_out`` (a column over the documents) does not hold are learned from. ``depth`` is 2 to 7."""
    if not 2 <= depth <= 7:
        raise ValueError("depth is 2 to 7")
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size, n_train = named.agg(F.sum(F.octet_length("text") + 1), F.count(F.when(~F.col("held_out"), 1))).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    ranges = min(4096, max(16, 1 << (blocks // 4).bit_length()))
    dealt = named.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"), "doc_id", "held_out", "text")
    packed = dealt.mapInArrow(_pack, "block int, data binary")
    asked = stored(packed.groupBy("block").applyInArrow(lambda g: _asks(g, depth, ranges), "r int, block int, keys binary, n binary"), "asked")
    merged, left = asked, blocks
    while True:
        up = merged.withColumn("up", F.floor(F.col("block") / MERGE))
        merged = stored(up.groupBy("r", "up").applyInArrow(lambda g: _merge(g.drop_columns(["up"])), "r int, block int, keys binary, n binary"), "merged")
        left = -(-left // MERGE)
        if left == 1:
            break
    sums = merged.mapInArrow(lambda bs: _tops(bs, depth, ranges), "c int, node int, zeros double, ones double, w double").groupBy("c", "node").agg(*[F.sum(x).alias(x) for x in ("zeros", "ones", "w")])
    rows = sums.toArrow()  # at most 256 x 255 rows and one
    of_words = rows.filter(pa.array([c < 0 for c in rows.column("c").to_pylist()], pa.bool_()))
    top = tops(rows.filter(pa.array([c >= 0 for c in rows.column("c").to_pylist()], pa.bool_())))
    distinct, tokens = (int(sum(of_words.column(x).to_pylist())) for x in ("zeros", "ones"))
    known = (tokens + n_train, distinct + (n_train > 0), n_train)
    sent = docs.sparkSession.sparkContext.broadcast(top)
    model = stored(merged.mapInArrow(lambda bs: _model(bs, depth, ranges, sent.value), "mr int, all binary, values binary"), "model")
    answers = asked.select("r", "block", "keys").join(model, F.col("r") == F.col("mr")).mapInArrow(lambda bs: _answers(bs, ranges), "block int, words boolean, keys binary, values binary")
    kind = named.schema["doc_id"].dataType.simpleString()
    arrow = pa.schema([("doc_id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda a, b: _scores(a, b, depth, known, arrow), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
