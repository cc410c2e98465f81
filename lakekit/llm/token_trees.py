"""Token counts that follow edits.

The text of a document is cut by the tokenizer's pattern into pre-tokens, which are encoded one by one, so a count is a sum over
pre-tokens. A document keeps two segment trees over its leaves, a leaf being ``LEAF`` neighbouring pre-tokens: the tokens and the
characters below every node (heap order; node 1 is the root, 2 * i and 2 * i + 1 are the children of i). An edit (start, deleted characters,
inserted text) descends the character tree to its place, begins with the leaf that the character two before it lies in
(the pattern looks two characters ahead at most), and cuts pre-tokens from there until one ends at an old leaf border behind
the edit: from there on the old cut holds. Only these pre-tokens are encoded again; the first touched leaf takes
their sums, the others become empty, and the sums above them are updated. A leaf that has grown is cut no finer.

Edits of a document are applied in their order, each to the text that the one before it left; they come as an array in the row of the
document (``attach`` makes it from a table of edits). A start beyond the text appends, a negative one counts as 0; a NULL text is
empty; NULL edits, or none, change nothing. Work and memory per document follow its text and its own edits. Trees are exact: the
root equals the count of the edited text encoded as a whole. Repeated rows are edited each for itself.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import pieces, without

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that belongs to the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOOK = 2
LEAF = 8
EDITS = "array<struct<start:int,deleted:int,inserted:string>>"


class Counter:
    """Tokens of pre-tokens, remembered; the memory is emptied when full."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN, most: int = 500_000):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern, self.most = regex.compile(pattern), most
        self.known: dict[str, int] = {}

    def sizes(self, cut: list[str]) -> list[int]:
        known = self.known
        out = list(map(known.get, cut))
        if None in out:
            if len(known) > self.most:
                known.clear()
            for x in dict.fromkeys(cut):
                if x not in known:
                    known[x] = len(self.encoding.encode_ordinary(x))
            out = list(map(known.get, cut))
        return out

    def count(self, text: str) -> int:
        return sum(self.sizes(self.pattern.findall(text)))


def plant(leaves: np.ndarray) -> np.ndarray:
    """Heap of sums over the leaves, as many as the next power of two."""
    size = 1 << max(0, int(len(leaves) - 1).bit_length())
    tree = np.zeros(2 * size, np.int32)
    tree[size : size + len(leaves)] = leaves
    while size > 1:
        half = size >> 1
        tree[half:size] = tree[size : 2 * size : 2] + tree[size + 1 : 2 * size : 2]
        size = half
    return tree


def grow(text: str, counter: Counter) -> tuple[np.ndarray, np.ndarray, int]:
    """(token tree, character tree, pre-tokens) of a text."""
    cut = counter.pattern.findall(text)
    tokens = np.array(counter.sizes(cut), np.int32)
    chars = np.fromiter(map(len, cut), np.int32, len(cut))
    at = np.arange(0, len(cut), LEAF)
    return plant(np.add.reduceat(tokens, at) if len(at) else tokens), plant(np.add.reduceat(chars, at) if len(at) else chars), len(cut)


def _leaf_at(tree: np.ndarray, place: int) -> tuple[int, int]:
    """(leaf, its first character) of the leaf that holds the character ``place``; the last one with characters if there is none."""
    size, node, before = len(tree) >> 1, 1, 0
    place = min(max(place, 0), max(int(tree[1]) - 1, 0))
    while node < size:
        node *= 2
        if before + tree[node] <= place and tree[node + 1]:
            before += int(tree[node])
            node += 1
    return node - size, before


def _set(tree: np.ndarray, first: int, values: list[int]) -> None:
    size = len(tree) >> 1
    low, high = size + first, size + first + len(values) - 1
    tree[low : high + 1] = values
    while low > 1:
        low, high = low >> 1, high >> 1
        tree[low : high + 1] = tree[2 * low : 2 * high + 2 : 2] + tree[2 * low + 1 : 2 * high + 2 : 2]


def apply_edit(text: str, tokens: np.ndarray, chars: np.ndarray, edit: tuple[int, int, str], counter: Counter) -> tuple[str, int]:
    """Change both trees in place; (new text, pre-tokens that were encoded again)."""
    start = min(max(edit[0], 0), len(text))
    stop = min(start + max(edit[1], 0), len(text))
    new = text[:start] + edit[2] + text[stop:]
    behind, shift = start + len(edit[2]), len(new) - len(text)
    size = len(chars) >> 1
    leaf, first = _leaf_at(chars, start - LOOK)
    last, border = leaf + 1, first + int(chars[size + leaf])  # the old border behind leaf last - 1, in the old text
    cut, done = [], first
    while True:
        while last < size and border + shift < max(done, behind):
            border += int(chars[size + last])
            last += 1
        if done >= len(new) or (done >= behind and border + shift == done):
            break
        m = counter.pattern.match(new, done)
        cut.append(m.group())
        done = m.end()
    if done >= len(new):
        last = size
    got = counter.sizes(cut)
    n = last - leaf
    _set(tokens, leaf, [sum(got)] + [0] * (n - 1))
    _set(chars, leaf, [done - first] + [0] * (n - 1))
    return new, len(cut)


_I32 = pa.list_(pa.int32())


def _build(batches: Iterator[pa.RecordBatch], ranks: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    counter = Counter(ranks, pattern)
    for b in pieces(batches, "text", 2 << 20):
        grown = [grow(x or "", counter) for x in b.column("text").to_pylist()]
        made = [pa.array([g[0] for g in grown], _I32), pa.array([g[1] for g in grown], _I32), pa.array([int(g[0][1]) for g in grown], pa.int64()), pa.array([g[2] for g in grown], pa.int64())]
        yield pa.record_batch([*b.columns, *made], names=[*b.schema.names, "token_tree", "char_tree", "n_tokens", "n_pretokens"])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


_TREES = ["text", "token_tree", "char_tree", "n_tokens", "n_pretokens"]


def _ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def build(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``keep``, text and the trees of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(_ranks(ranks))  # the rank file, under a megabyte
    kept = without(docs.select(*keep), _TREES)
    named = docs.select(*kept.columns, F.col(text).cast("string").alias("text"))
    return named.mapInArrow(lambda bs: _build(bs, sent.value, pattern), f"{_ddl(named)}, token_tree array<int>, char_tree array<int>, n_tokens long, n_pretokens long")


def attach(trees: DataFrame, edits: DataFrame, doc_id: str = "doc_id", order: str = "seq") -> DataFrame:
    """The trees with the edits of each document as an array in their order (ties: by place and text)."""
    each = edits.groupBy(F.col(doc_id).alias("_doc")).agg(F.sort_array(F.collect_list(F.struct(order, "start", "deleted", "inserted"))).alias("_e"))
    each = each.select("_doc", F.transform("_e", lambda e: F.struct(e["start"].cast("int").alias("start"), e["deleted"].cast("int").alias("deleted"), e["inserted"].cast("string").alias("inserted"))).alias("edits"))
    return trees.join(each, F.col(doc_id) == F.col("_doc"), "left").drop("_doc")


def _apply(batches: Iterator[pa.RecordBatch], ranks: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    counter = Counter(ranks, pattern)
    for b in pieces(batches, "text", 2 << 20):
        at = {n: b.schema.get_field_index(n) for n in [*_TREES, "edits"]}
        texts, again = [], []
        trees: tuple[list, list] = ([], [])
        for i, (text, edits) in enumerate(zip(b.column(at["text"]).to_pylist(), b.column(at["edits"]).to_pylist())):
            tokens, chars = (np.array(b.column(at[n])[i].values.to_numpy(zero_copy_only=False)) for n in ("token_tree", "char_tree"))
            text, redone = text or "", 0
            for e in edits or []:
                if e is not None:
                    text, n = apply_edit(text, tokens, chars, (e["start"] or 0, e["deleted"] or 0, e["inserted"] or ""), counter)
                    redone += n
            texts.append(text)
            again.append(redone)
            trees[0].append(tokens)
            trees[1].append(chars)
        cols = {n: c for n, c in zip(b.schema.names, b.columns) if n not in ("edits", "n_pretokens")}
        cols["n_before"] = cols["n_tokens"]
        cols |= {"text": pa.array(texts, pa.string()), "token_tree": pa.array(trees[0], _I32), "char_tree": pa.array(trees[1], _I32), "n_tokens": pa.array([int(t[1]) for t in trees[0]], pa.int64()), "n_encoded_again": pa.array(again, pa.int64())}
        yield pa.record_batch(list(cols.values()), names=list(cols))


def edit(trees: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Apply the column ``edits`` to every document: text, trees and n_tokens are those after the edits, n_before the count before them."""
    sent = trees.sparkSession.sparkContext.broadcast(_ranks(ranks))
    typed = trees.withColumn("edits", F.col("edits").cast(EDITS))
    kept = typed.drop("edits", "n_pretokens")
    return typed.mapInArrow(lambda bs: _apply(bs, sent.value, pattern), f"{_ddl(kept)}, n_before long, n_encoded_again long")
