"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text is ``▁`` (the dummy prefix) and the text with ``▁`` for every space. No piece of the model holds ``▁`` after another character, so
a text falls into words, each ``▁`` and what follows up to the next space. Words that a task has not met yet are encoded
together: words of like length form a matrix and advance position by position; hashes of the substrings that start there probe
a table of the pieces and of their beginnings, and a vectorised maximum over the pieces stores the way back. Everything else is gathering ids.

Two kinds of models are served. In a unigram model a path's value is the sum of the scores of its pieces. In a merge (BPE) model a piece
may follow another only if the merges would really leave the two side by side; this makes the path unique and equal to the merge
order's result, so the ids are those of the SentencePiece library. Whether two pieces may stand side by side is found by undoing their
merges, the later one first, until a merge across the border would have come earlier (not allowed) or none is left (allowed).
Runs of spaces, whose pieces all have one score, follow the leftmost-first order and are tabulated. Characters without a piece become
byte pieces, or the unknown id where the model has none.

NULL text gives NULL ids and no tokens; empty text an empty list. ``▁`` in a text decodes as a space, as the format has it. A model file is
a parameter and reaches the executors by broadcast. Extra columns are passed on only if named in ``keep``; repeated rows are
encoded alike. The table of words that a task keeps is emptied when it is full, so memory does not follow the vocabulary.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import pieces, text_bytes, without

SPACE = "▁"
LINE = "\x00"  # stands for a line end that was cut from the word before it
GUARD = "\ue000"
BASE = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = -1
BATCH = 1 << 20  # bytes of text that are encoded together; arrays with an entry per byte follow it
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def load_model(path: str = MODEL, file: bytes | None = None) -> dict:
    """Tables of a model: keys of the pieces, their ids and scores, and for merges which pieces may stand side by side."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=file) if file else sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
    plain = [i for i in range(len(names)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    by_text = {names[i]: i for i in plain}
    if any(SPACE in x.lstrip(SPACE) for x in by_text):
        raise ValueError("pieces that hold a space inside are not supported")
    score = np.array([sp.get_score(i) for i in range(len(names))])
    merges = bool(all(float(score[i]).is_integer() for i in plain))
    t = {"names": names, "score": score, "merges": merges, "unknown": sp.unk_id(), "longest": max(map(len, by_text))}
    code = {sp.id_to_piece(i): i for i in range(len(names)) if sp.is_byte(i)}
    t["byte"] = np.array([code.get(f"<0x{b:02X}>", -1) for b in range(256)])
    t["bytes"] = [bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else b"" if sp.is_control(i) else names[i].replace(SPACE, " ").encode() for i in range(len(names))]
    if merges:
        _merge_tables(t, by_text)
    starts = dict.fromkeys((x[:k] for x in by_text for k in range(1, len(x) + 1)), UNKNOWN)
    starts |= {x: i for x, i in by_text.items() if not merges or t["whole"][i]}
    keys = np.array([_key(x) for x in starts], np.uint64)
    order = np.argsort(keys)
    t["keys"], t["ids"] = keys[order], np.array(list(starts.values()))[order]
    if (t["keys"][1:] == t["keys"][:-1]).any():
        raise ValueError("two pieces share a key")
    t["starts"] = slots_of(t["keys"])
    t["spaces"] = [_merge(SPACE * n, by_text, score)[0] if merges else None for n in range(65)]
    return t


def slots_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Distinct keys dealt over eight times as many slots or more; one whose slot is taken goes to the next: (keys, their places, shift)."""
    bits = max(4, (8 * len(keys)).bit_length())
    slots, place, shift = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32), np.uint64(64 - bits)
    left = np.arange(len(keys), dtype=np.int32)
    at = (keys * BASE >> shift).astype(np.int64)
    while len(left):
        free = place[at] < 0
        place[at[free]] = left[free]
        done = place[at] == left
        slots[at[done]] = keys[left[done]]
        left, at = left[~done], at[~done] + 1 & (1 << bits) - 1
    return slots, place, shift


def find(table: tuple[np.ndarray, np.ndarray, np.uint64], keys: np.ndarray) -> np.ndarray:
    """The places of keys among those of ``slots_of``, -1 for others."""
    slots, place, shift = table
    at = (keys * BASE >> shift).astype(np.int64)
    got = place[at]
    other = slots[at] != keys
    again = np.flatnonzero(other & (got >= 0))
    got[other] = -1
    at = at[again]
    while len(again):
        at = at + 1 & len(slots) - 1
        near, same = place[at], slots[at] == keys[again]
        got[again[same]] = near[same]
        on = ~same & (near >= 0)
        again, at = again[on], at[on]
    return got


def _key(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(BASE) + ord(c) + 1) & (1 << 64) - 1
    return h


def _merge(word: str, by_text: dict[str, int], score: np.ndarray) -> tuple[list[int], tuple[str, str] | None]:
    """Merge the best adjacent pair, leftmost first, until none is left: (ids, the pair of the last merge)."""
    parts, last = list(word), None
    while True:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = by_text.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or score[s] > best):
                best, at = score[s], i
        if at < 0:
            return [by_text.get(p, UNKNOWN) for p in parts], last
        last = (parts[at], parts[at + 1])
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def _merge_tables(t: dict, by_text: dict[str, int]) -> None:
    n = len(t["names"])
    t["rank"] = np.full(n, -1.0)
    t["left"], t["right"], t["whole"] = np.arange(n), np.arange(n), np.zeros(n, bool)
    pair, merged = [], []
    for text, i in by_text.items():
        ids, last = _merge(text, by_text, t["score"])
        t["whole"][i] = ids == [i]
        if len(text) > 1:
            t["rank"][i] = -t["score"][i]
            if last and ids == [i]:
                t["left"][i], t["right"][i] = by_text[last[0]], by_text[last[1]]
            for k in range(1, len(text)):
                a, b = by_text.get(text[:k]), by_text.get(text[k:])
                if a is not None and b is not None:
                    pair.append(a * n + b)
                    merged.append(i)
    order = np.argsort(pair)
    t["pairs"], t["merged_rank"] = slots_of(np.array(pair, np.uint64)[order]), t["rank"][np.array(merged, int)][order]


def side_by_side(t: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the merges leave piece a directly before piece b."""
    n = len(t["names"])
    ok = np.ones(len(a), bool)
    limit = np.full(len(a), np.inf)
    live = np.flatnonzero((a >= 0) & (b >= 0))
    a, b = a.copy(), b.copy()
    while len(live):
        x, y = a[live], b[live]
        at = find(t["pairs"], (x * n + y).astype(np.uint64))
        earlier = at >= 0
        earlier[earlier] = t["merged_rank"][at[earlier]] < limit[live[earlier]]
        ok[live[earlier]] = False
        rx, ry = t["rank"][x], t["rank"][y]
        first, second = ~earlier & (rx > ry), ~earlier & (rx <= ry) & (ry >= 0)
        i = live[first]
        limit[i], a[i] = rx[first], t["right"][x[first]]
        i = live[second]
        limit[i], b[i] = ry[second] + 0.5, t["left"][y[second]]
        live = live[first | second]
    return ok


def viterbi(t: dict, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all words joined, number per word) for words of falling length; UNKNOWN for a character without a piece.

    From every position the substrings that begin some piece are followed; the others drop out of the arrays, and so do words that have ended.
    """
    n, length = len(words), np.array([len(w) for w in words])
    size = int(length[0])
    longer = np.searchsorted(-length, -np.arange(size + 1))  # words longer than each position; they come first
    m = np.zeros((n, size), np.uint64)
    m[np.arange(size) < length[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    m = np.ascontiguousarray(m.T) + np.uint64(1)
    best = np.full((size + 1, n), -np.inf)
    best[0] = 0
    back, piece = np.zeros((size + 1, n), np.int32), np.full((size + 1, n), UNKNOWN, np.int64)
    low = t["score"].min() - 10
    starts = t["starts"] if "starts" in t else slots_of(t["keys"])
    for i in range(size):
        rows, h = np.arange(longer[i]), np.zeros(longer[i], np.uint64)
        found = []
        for k in range(1, min(t["longest"], size - i) + 1):
            if k > 1 and (left := np.searchsorted(rows, longer[i + k - 1])) < len(rows):
                rows, h = rows[:left], h[:left]
            h = h * BASE + m[i + k - 1][rows]
            at = find(starts, h)
            hit = at >= 0
            ids = np.where(hit, t["ids"][at], UNKNOWN)
            real = ids >= 0
            if k == 1:
                found.append((rows, ids, k))
            elif real.any():
                found.append((rows[real], ids[real], k))
            rows, h = rows[hit], h[hit]
            if not len(rows):
                break
        rows, ids = (np.concatenate([f[j] for f in found]) for j in (0, 1))
        steps = np.repeat([f[2] for f in found], [len(f[0]) for f in found])
        if t["merges"]:
            if i:
                fits = side_by_side(t, piece[i][rows], ids)
                rows, ids, steps = rows[fits], ids[fits], steps[fits]
            value = np.zeros(len(rows))
        else:
            value = best[i][rows] + np.where(ids >= 0, t["score"][ids], low)
        better = value > best[i + steps, rows]
        rows, ids, steps = rows[better], ids[better], steps[better]
        to = i + steps
        best[to, rows], back[to, rows], piece[to, rows] = value[better], steps, ids
    at, steps, every = length.copy(), [], np.arange(n)
    while (on := at > 0).any():
        steps.append(np.where(on, piece[at, every], UNKNOWN - 1))
        at = at - np.where(on, back[at, every], 0)
    got = np.array(steps[::-1]).T
    real = got > UNKNOWN - 1
    return got[real], real.sum(1)


class Encoder:
    """Encodes words once and keeps their ids in one pool."""

    def __init__(self, tables: dict, most: int = 400_000):
        self.t, self.most = tables, most
        self.line = self._ids(["\n"])[0]
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.pool, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _spaces(self, n: int) -> list[int]:
        table = self.t["spaces"]
        if not self.t["merges"]:
            return self._ids([SPACE * n])[0]
        head = []
        block = self.t["longest"]
        whole = table[block] if block < len(table) else None
        while n >= len(table) and whole:  # a full block is closed before the rest is merged
            head += whole
            n -= block
        return head + (table[n] if n < len(table) else table[1] * n)

    def _final(self, word: str, ids: list[int]) -> list[int]:
        """Byte pieces for characters without a piece."""
        out, c = [], 0
        for i in ids:
            if i == UNKNOWN:
                codes = self.t["byte"][list(word[c].encode("utf-8", "surrogatepass"))]
                out += codes.tolist() if (codes >= 0).all() else [self.t["unknown"]]
                c += 1
            else:
                out.append(i)
                c += len(self.t["names"][i])
        return out

    def _encode_new(self, keys: list[str]) -> list[list[int]]:
        """A key is a word (without its space), a word after a line end, or a run of spaces with the word that follows."""
        bodies = []
        for k in keys:
            if k[:1] == LINE:
                bodies.append(k[1:])
            elif k[:1] == SPACE:
                rest = k.lstrip(SPACE)
                bodies.append(SPACE + rest if rest else "")
            else:
                bodies.append(SPACE + (k[1:] if k[:1] == GUARD else k))
        words = sorted(dict.fromkeys(filter(None, bodies)), key=len, reverse=True)
        done = {"": []}
        i = 0
        while i < len(words):  # words of like length: none is shorter than half the first
            size = len(words[i])
            upto = min(bisect_right(words, -(size // 2), i, key=lambda w: -len(w)), i + max(1, 1_000_000 // (size + 1)))
            done.update(zip(words[i:upto], self._ids(words[i:upto])))
            i = upto
        one = self.t["spaces"][1] if self.t["merges"] else None
        out = []
        for k, w in zip(keys, bodies):
            ids = done[w]
            if k[:1] == LINE:
                ids = self.line + ids
            elif k[:1] == SPACE:
                n = len(k) - len(k.lstrip(SPACE))
                if w and one and ids[:1] == one:  # the space before the word stays alone and joins the run
                    ids = self._spaces(n + 1) + ids[1:]
                else:
                    ids = self._spaces(n) + ids
            out.append(ids)
        return out

    def _ids(self, words: list[str]) -> list[list[int]]:
        ids, size = viterbi(self.t, words)
        flat, ends = ids.tolist(), np.cumsum(size).tolist()
        got = [flat[a:b] for a, b in zip([0, *ends], ends)]
        if (ids < 0).any():
            got = [self._final(w, x) if UNKNOWN in x else x for w, x in zip(words, got)]
        return got

    def keys_of(self, text: str) -> list[str]:
        if not text:
            return []
        s = text.replace(SPACE, " ")
        cut = LINE not in s and GUARD not in s
        parts = (s.replace("\n", " " + LINE) if cut else s).split(" ")
        if "" not in parts:
            return parts if cut else self._odd(parts)
        out, run = [], 0
        for p in parts:
            if p == "":
                run += 1
            elif p[0] == LINE and cut:
                out += [SPACE * run, p] if run else [p]
                run = 0
            else:
                out.append(SPACE * run + p if run else p)
                run = 0
        out += [SPACE * run] if run else []
        return out if cut else self._odd(out)

    def _odd(self, parts: list[str]) -> list[str]:
        """Words of a text that holds the mark itself: one that begins with it gets a guard, which a word may not begin with either."""
        return [GUARD + p if p[:1] in (LINE, GUARD) else p for p in parts]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, offsets)."""
        keys, ends = [], []
        for x in texts:
            if x:
                keys += self.keys_of(x)
            ends.append(len(keys))
        if len(self.at) > self.most:
            self.clear()
        get = self.at.get
        idx = np.array(list(map(get, keys, repeat(-1))), np.int64)
        if len(unmet := np.flatnonzero(idx < 0)):
            asked = [keys[i] for i in unmet.tolist()]
            new = list(dict.fromkeys(asked))
            ids = self._encode_new(new)
            size = np.array([len(x) for x in ids], np.int64)
            self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.pool = np.concatenate([self.pool, np.array(list(chain.from_iterable(ids)), np.int32)])
            first = len(self.at)
            self.at.update(zip(new, range(first, first + len(new))))
            idx[unmet] = list(map(get, asked))
        size = self.size[idx]
        upto = np.concatenate(([0], np.cumsum(size)))
        ids = self.pool[np.repeat(self.start[idx] - upto[:-1], size) + np.arange(upto[-1])] if len(idx) else np.zeros(0, np.int32)
        return ids, upto[np.concatenate(([0], ends)).astype(np.int64)]


def decoder(t: dict):
    pool = np.frombuffer(b"".join(t["bytes"]), np.uint8)
    size = np.array([len(x) for x in t["bytes"]], np.int64)
    start = np.cumsum(size) - size

    def decode(ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts joined, offsets); the space of the dummy prefix is taken off."""
        n = size[ids]
        upto = np.concatenate(([0], np.cumsum(n)))
        data = pool[np.repeat(start[ids] - upto[:-1], n) + np.arange(upto[-1])] if len(ids) else np.zeros(0, np.uint8)
        ends = upto[off]
        full = ends[1:] > ends[:-1]
        firsts = ends[:-1][full]
        firsts = firsts[data[firsts] == 32]
        keep = np.ones(len(data), bool)
        keep[firsts] = False
        gone = np.concatenate(([0], np.cumsum(~keep)))
        return data[keep], ends - gone[ends]

    return decode


def _spaced(col: pa.Array) -> pa.Array:
    return pc.replace_substring(col, SPACE, " ")


def _encode(batches: Iterator[pa.RecordBatch], tables: dict) -> Iterator[pa.RecordBatch]:
    encoder, decode = Encoder(tables), decoder(tables)
    for b in pieces(batches, "text", BATCH):
        col = b.column("text")
        ids, off = encoder.encode(col.to_pylist())
        data, ends = decode(ids, off)
        want, at = text_bytes(_spaced(col))
        same = np.diff(at) == np.diff(ends)
        if len(data) == len(want) and same.all():
            wrong = np.concatenate(([0], np.cumsum(data != want)))
            same = wrong[at[1:]] == wrong[at[:-1]]
        else:
            same = np.array([data[ends[i] : ends[i + 1]].tobytes() == want[at[i] : at[i + 1]].tobytes() for i in range(b.num_rows)], bool)
        null = ~col.is_valid().to_numpy(zero_copy_only=False)
        lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(null))
        yield pa.record_batch([*b.columns[:-1], pa.array(np.diff(off), pa.int64()), lists, pa.array(same, pa.bool_(), mask=null)], names=[*b.schema.names[:-1], "n_tokens", "ids", "round_trip"])


def _ddl(df: DataFrame) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]


def encode(docs: DataFrame, model: str | dict = MODEL, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_tokens, ids, round_trip (the ids decode to the text, with a space for every ``▁``)."""
    sent = docs.sparkSession.sparkContext.broadcast(load_model(model) if isinstance(model, str) else model)
    kept = without(docs.select(*keep), ["text", "n_tokens", "ids", "round_trip"])
    named = docs.select(*kept.columns, F.col(text).cast("string").alias("text"))
    return named.mapInArrow(lambda bs: _encode(bs, sent.value), ", ".join([*_ddl(kept), "n_tokens long, ids array<int>, round_trip boolean"]))


def _decode(batches: Iterator[pa.RecordBatch], tables: dict) -> Iterator[pa.RecordBatch]:
    decode, n = decoder(tables), len(tables["names"])
    for b in batches:
        for first in range(0, b.num_rows, 256):
            part = b.slice(first, 256)
            col = part.column("ids")
            rows = [np.array([i for i in x or [] if i is not None and 0 <= i < n], np.int64) for x in col.to_pylist()]
            off = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
            data, ends = decode(np.concatenate([*rows, np.zeros(0, np.int64)]), off)
            texts = [data[ends[i] : ends[i + 1]].tobytes().decode("utf-8", "replace") if v else None for i, v in enumerate(col.is_valid().to_pylist())]
            yield pa.record_batch([*part.columns[:-1], pa.array(texts, pa.string())], names=[*part.schema.names[:-1], "text"])


def decode(encoded: DataFrame, model: str | dict = MODEL, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, text. NULL ids give NULL; ids outside the model are left out; bytes that are no UTF-8 become U+FFFD."""
    sent = encoded.sparkSession.sparkContext.broadcast(load_model(model) if isinstance(model, str) else model)
    kept = without(encoded.select(*keep), ["text", "ids"])
    named = encoded.select(*kept.columns, F.col(ids).cast("array<int>").alias("ids"))
    return named.mapInArrow(lambda bs: _decode(bs, sent.value), ", ".join([*_ddl(kept), "text string"]))
