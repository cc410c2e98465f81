"""Substring dedup by repeated-phrase automata: words inside passages that stand elsewhere as well are removed.

A window is ``window`` (35) consecutive words of one document; it recurs when its word sequence starts at any other place, in the
same document or another. Every word covered by a recurring window goes; windows are judged on the input.

1. *Anchors.* Of the runs of ``anchor`` (8) words inside a window, the one with the smallest hash (the first, on ties) is its
   anchor. Equal windows have equal anchors at equal places, and neighbouring windows mostly share theirs, so about one word in
   fourteen is sent. Texts are written once in blocks of about ``block_bytes``; every block reports its distinct anchors with counts.
2. *Confirmed passages.* Only windows around anchors that are found twice can recur. The windows around one place of an anchor are
   its surroundings, with one hash for all. Surroundings found twice are confirmed as a whole, which settles copies with one row per
   block; only anchors that stand in different surroundings have their windows counted one by one. The anchor of what is confirmed is
   a phrase of text.
3. *Automata.* There is one shard per block of documents: an Aho-Corasick automaton of the confirmed phrases that this block
   holds. All documents are streamed through the automaton of their block, which finds every occurrence of every phrase; the
   confirmed windows around an occurrence are marked. A phrase is compared as text, what is around it by 64 bits of hash beside it.

Shards follow the documents, so each text meets one automaton whatever the size of the corpus, and an automaton is no larger than the
text of its block. Nothing is broadcast or collected. A passage in very many documents is one row per block at most.

NULL, empty and white texts have no words; texts shorter than a window keep all theirs. Repeated rows and equal ids are documents of
their own (and copies of each other). One very long text is a block of its own. An empty table gives no rows. Columns named in ``keep``
are passed on unless they clash with a result column; others are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import _powers, mix, pieces, runs, span_hashes, stored, text_bytes, without, word_spans

WINDOW = 35
ANCHOR = 8
BLOCK_BYTES = 2 << 20
_LOW = np.uint64((1 << 32) - 1)


class Words(NamedTuple):
    """The words of a column of texts, one after the other, and its windows."""

    data: np.ndarray  # the words' bytes, a space after each
    start: np.ndarray  # of every word in ``data``
    stop: np.ndarray
    ends: np.ndarray  # words up to every row, from 0: one more than rows
    gram: np.ndarray  # hash of the anchor-long run from every word on
    at: np.ndarray  # first word of every window
    anchor: np.ndarray  # first word of its anchor
    hash: np.ndarray  # of the window


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n values."""
    up, down = _powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(h) - n + 1])


def least_of(key: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n neighbours."""
    size = 1
    while size * 2 <= n:
        key, size = np.minimum(key[:-size], key[size:]), size * 2
    return np.minimum(key[: len(key) - (n - size)], key[n - size :]) if size < n else key


def words_of(col: pa.Array, window: int, anchor: int) -> Words:
    raw, off = text_bytes(col)
    a, b, row = word_spans(raw, off)
    size = b - a
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    at = np.arange(stop[-1] + 1 if len(stop) else 0) + np.repeat(a - start, size + 1)
    data = raw[np.minimum(at, len(raw) - 1)] if len(at) else np.zeros(0, np.uint8)
    data[stop] = 32
    ends = np.searchsorted(row, np.arange(len(col) + 1))
    none = np.zeros(0, np.int64)
    if len(a) < window:
        return Words(data, start, stop, ends, np.zeros(0, np.uint64), none, none, np.zeros(0, np.uint64))
    h = span_hashes(data, start, stop)
    gram = run_hashes(h, anchor)
    key = gram & ~_LOW | np.arange(len(gram), dtype=np.uint64)
    first = np.arange(len(a) - window + 1)
    fits = row[first] == row[first + window - 1]
    low = (least_of(key, window - anchor + 1) & _LOW).astype(np.int64)
    return Words(data, start, stop, ends, gram, first[fits], low[fits], run_hashes(h, window)[fits])


def _blocks(batches: Iterator[pa.RecordBatch], window: int, anchor: int, size: int) -> Iterator[pa.RecordBatch]:
    """Every row with the number of its block; the first row of a block holds the block's anchors and how many places they have (2: two or more)."""
    number = (TaskContext.get().partitionId() << 32) - 1
    for b in pieces(batches, "text", size):
        number += 1
        w = words_of(b.column("text"), window, anchor)
        g, n = np.unique(w.gram[w.anchor[runs(w.anchor)]], return_counts=True)
        first = lambda x, kind: pa.array([x] + [None] * (b.num_rows - 1), pa.list_(kind))
        yield pa.record_batch([*b.columns, pa.array(np.full(b.num_rows, number)), first(g.view(np.int64), pa.int64()), first(np.minimum(n, 2).astype(np.int32), pa.int32())], names=[*b.schema.names, "_block", "_anchors", "_places"])


def _text(group: pa.Table) -> pa.Array:
    col = group.column("text").combine_chunks()
    return col.chunk(0) if isinstance(col, pa.ChunkedArray) else col


class Places(NamedTuple):
    """Where anchors stand: the anchor's first word, its windows (from, to) and the hash of all these."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    around: np.ndarray


def places_of(w: Words) -> Places:
    first = runs(w.anchor)
    last = np.append(first[1:], len(w.anchor))
    up, down = _powers(len(w.hash) + 1)
    sums = np.zeros(len(w.hash) + 1, np.uint64)
    np.cumsum(w.hash * up[: len(w.hash)], out=sums[1:])
    return Places(w.anchor[first], first, last, mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))


_CONFIRM = "_block long, _g long, _phrase string, _around long, _n int, _w array<long>"


def _windows(docs: pa.Table, found: pa.Table, window: int, anchor: int) -> pa.Table:
    """Anchors that recur, with their surroundings in this block: the phrase, how many places there are (2: two or more), the windows."""
    schema = pa.schema([("_block", pa.int64()), ("_g", pa.int64()), ("_phrase", pa.string()), ("_around", pa.int64()), ("_n", pa.int32()), ("_w", pa.list_(pa.int64()))])
    if not docs.num_rows or not found.num_rows:
        return schema.empty_table()
    w = words_of(_text(docs), window, anchor)
    p = places_of(w)
    g = w.gram[p.at]
    here = np.flatnonzero(np.isin(g, found.column("_g").to_numpy().view(np.uint64)))
    here = here[np.lexsort((p.around[here], g[here]))]
    new = (g[here][1:] != g[here][:-1]) | (p.around[here][1:] != p.around[here][:-1])
    cut = np.flatnonzero(np.concatenate(([True], new))) if len(here) else np.zeros(0, np.int64)
    n = np.minimum(np.diff(np.append(cut, len(here))), 2)
    here = here[cut]
    size = p.last[here] - p.first[here]
    ends = np.concatenate(([0], np.cumsum(size)))
    each = np.arange(ends[-1]) + np.repeat(p.first[here] - ends[:-1], size)
    phrase = [w.data[w.start[a] : w.stop[a + anchor - 1]].tobytes().decode() for a in p.at[here]]
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(w.hash[each].view(np.int64)))
    return pa.table([pa.array(np.full(len(here), docs.column("_block")[0].as_py())), pa.array(g[here].view(np.int64)), pa.array(phrase, pa.string()), pa.array(p.around[here].view(np.int64)), pa.array(n, pa.int32()), lists], schema=schema)


def automaton(phrases: Sequence[str]) -> ahocorasick.Automaton:
    """Finds phrases (words joined by single spaces) between spaces."""
    a = ahocorasick.Automaton()
    for i, p in enumerate(phrases):
        a.add_word(f" {p} ", i)
    a.make_automaton()
    return a


def _occurrences(w: Words, phrases: Sequence[str], anchor: int) -> np.ndarray:
    """For every word, which phrase starts there, or -1: all texts of the block in one run of the automaton."""
    first = np.append(w.start, len(w.data))
    rows = [w.data[first[a] : first[b]].tobytes().decode() for a, b in zip(w.ends[:-1], w.ends[1:])]
    text = " " + "\n ".join(rows)  # line feeds part the texts; no phrase holds one
    chars = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))[w.start] + 1 + 2 * np.repeat(np.arange(len(rows)), np.diff(w.ends))
    hits = np.array(list(automaton(phrases).iter(text)), np.int64).reshape(-1, 2)
    at = np.full(len(w.start), -1)
    at[np.searchsorted(chars, hits[:, 0]) - anchor] = hits[:, 1]
    return at


def _covered(w: Words, found: pa.Table, window: int, anchor: int) -> np.ndarray:
    """Which words lie in a confirmed window around an occurrence of its phrase."""
    mark = np.zeros(len(w.start) + 1, np.int64)
    named = found.filter(found.column("_phrase").is_valid())
    phrases = dict(zip(named.column("_g").to_pylist(), named.column("_phrase").to_pylist()))
    if phrases and len(w.at):
        p = places_of(w)
        which = _occurrences(w, list(phrases.values()), anchor)[p.at]
        number = {g: i for i, g in enumerate(phrases)}
        index = np.array([number[g] for g in found.column("_g").to_pylist()], np.uint64)
        kind, key = found.column("_kind").to_numpy(), found.column("_key").fill_null(0).to_numpy().view(np.uint64)
        both = key ^ mix(index + np.uint64(1))
        whole = (which >= 0) & np.isin(p.around ^ mix((which + 1).astype(np.uint64)), both[kind == 0])
        each = np.repeat(np.where(whole, -1, which), p.last - p.first)
        sure = np.repeat(whole, p.last - p.first) | (each >= 0) & np.isin(w.hash ^ mix((each + 1).astype(np.uint64)), both[kind == 1])
        np.add.at(mark, w.at[sure], 1)
        np.add.at(mark, w.at[sure] + window, -1)
    return np.cumsum(mark)[:-1] > 0


def _locate(docs: pa.Table, found: pa.Table, window: int, anchor: int, schema: pa.Schema) -> pa.Table:
    if not docs.num_rows:
        return schema.empty_table()
    w = words_of(_text(docs), window, anchor)
    gone = _covered(w, found, window, anchor)
    edge = np.concatenate(([0], np.cumsum(gone)))
    n_removed = edge[w.ends[1:]] - edge[w.ends[:-1]]
    byte_kept = np.repeat(~gone, w.stop - w.start + 1)
    first = np.append(w.start, len(w.data))
    kept, spans = [], []
    for a, b, n in zip(w.ends[:-1], w.ends[1:], n_removed):
        part = w.data[first[a] : first[b]]
        kept.append((part[byte_kept[first[a] : first[b]]] if n else part).tobytes()[:-1].decode())
        step = np.flatnonzero(np.diff(np.concatenate(([0], gone[a:b], [0])))) if n else []
        spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(step[::2], step[1::2])])
    own = {"n_words": pa.array(np.diff(w.ends), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "spans": pa.array(spans, schema.field("spans").type), "kept": pa.array(kept, pa.string())}
    return pa.table([own[f.name] if f.name in own else docs.column(f.name).cast(f.type) for f in schema], schema=schema)


def remove_repeats(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), window: int = WINDOW, anchor: int = ANCHOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns of every document, with n_words, n_removed, spans (of removed words: start and stop, by number from 0)
    and kept (the kept words joined by one space)."""
    base = without(docs.select(*dict.fromkeys(keep)), ["n_words", "n_removed", "spans", "kept", "text", "_block", "_anchors", "_places"])
    passed = base.columns
    rows = docs.select(*passed, F.col(text).cast("string").alias("text"))
    schema_in = T.StructType(rows.schema.fields + T.StructType.fromDDL("_block long, _anchors array<long>, _places array<int>").fields)
    blocks = stored(rows.mapInArrow(lambda bs: _blocks(bs, window, anchor, block_bytes), schema_in), "blocks")
    anchors = blocks.where(F.col("_anchors").isNotNull()).select("_block", F.inline(F.arrays_zip(F.col("_anchors").alias("_g"), F.col("_places").alias("_n"))))
    often = anchors.groupBy("_g").agg(F.sum("_n").alias("k")).where("k > 1")
    maybe = anchors.join(often, "_g", "left_semi").select(F.col("_block").alias("_b"), "_g")
    slim = blocks.select("_block", "text")
    found = stored(slim.groupBy("_block").cogroup(maybe.groupBy("_b")).applyInArrow(lambda d, f: _windows(d, f, window, anchor), _CONFIRM), "passages")
    # _kind 0: surroundings confirmed as a whole; 1: one window; 2: a phrase whose windows were counted one by one
    by_place = found.groupBy("_g", "_around").agg(F.sum("_n").alias("n"))
    whole = by_place.where("n > 1").select("_g", "_around")
    varied = by_place.groupBy("_g").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    null = F.lit(None)
    settled = found.join(whole, ["_g", "_around"], "left_semi").select("_block", "_g", F.lit(0).alias("_kind"), F.col("_around").alias("_key"), "_phrase")
    mixed = stored(found.join(varied, "_g", "left_semi"), "varied")
    open_ = mixed.join(whole, ["_g", "_around"], "left_anti")
    counted = mixed.select("_g", "_n", F.explode("_w").alias("_key")).groupBy("_g", "_key").agg(F.sum("_n").alias("n")).where("n > 1")
    single = open_.select("_block", "_g", F.explode("_w").alias("_key")).join(counted, ["_g", "_key"], "left_semi").select("_block", "_g", F.lit(1).alias("_kind"), "_key", null.cast("string").alias("_phrase"))
    named = open_.select("_block", "_g", F.lit(2).alias("_kind"), null.cast("long").alias("_key"), "_phrase")
    shard = stored(settled.unionByName(single).unionByName(named), "shards")
    out = T.StructType(base.schema.fields + T.StructType.fromDDL("n_words long, n_removed long, spans array<struct<start: long, stop: long>>, kept string").fields)
    arrow = to_arrow_schema(out)
    located = blocks.select(*passed, "text", "_block").groupBy("_block").cogroup(shard.groupBy("_block"))
    return located.applyInArrow(lambda d, f: _locate(d, f, window, anchor, arrow), out)
