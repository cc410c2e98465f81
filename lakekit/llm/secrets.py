"""Secrets in texts: fixed patterns, and a small character network for what the patterns miss.

One pass over the texts finds the spans of the fixed patterns and all candidates: runs of 16 or more of ``A-Za-z0-9+/_.=-`` that hold a
letter and a digit. A candidate is labelled by whether a pattern covers some of it; what the pattern leaves of such a run is scored on its own, without a label. A convolutional network over the characters of a
candidate and 16 characters on either side is trained on at most ``sample`` different labelled candidates of each label, taken in the
order of a hash (the bound on what is collected; besides these only counts are). One text in five, told by its hash, is held out with all its
surroundings: on those of the sample the scores are calibrated (logistic fit); then all held-out candidates of the table are scored, a repeated one counts once, and
from the counts of their scores the threshold is set so that at least ``recall`` of the labelled secrets pass, half way (in
log odds) to the harmless ones when the two are apart (but for the few highest, which may be secrets without a label). All candidates are scored; those above the threshold that no pattern covers are added as spans of
kind ``cnn``. Those few do not stay in the training either. Half of the training windows get the surroundings of another candidate, so that the network looks at the candidate itself.

Spans count code points, end exclusive, and are ordered by start, then kind. NULL or empty text has no spans. Without five different labelled
candidates of both kinds there is no network and nothing is added. Candidates longer than the window are scored window by
window, the highest counts. Repeated rows are scanned alike; extra columns are only passed on if named in ``keep``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces, stored, text_bytes, without

KINDS = ["assign", "access", "hex", "cnn"]
_either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
ASSIGN = re.compile("(" + "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # the same spans as the runs of 24 or more
LEAST = 16
CANDIDATE = re.compile("[A-Za-z0-9+/_.=-]{16,}")
KEYWORDS = [b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey"]
SIDE, BODY = 16, 40
WIDTH = 2 * SIDE + BODY
LONGEST = 4096  # of a candidate in the sample
UNIT, FAR = 256, 64  # scores are counted by log odds in steps of 1/256, from -64 to 64

_SOLID, _HEX, _DIGIT = (np.array([bool(re.match(p, chr(i))) for i in range(256)]) & (np.arange(256) < 128) for p in ("[A-Za-z0-9+/_.=-]", "[0-9a-f]", "[0-9]"))
_LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

SPANS = "array<struct<kind:int,start:int,end:int>>"
CANDIDATES = "array<struct<start:int,end:int,label:boolean,before:string,body:string,after:string>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    out = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [(2, *m.span()) for m in HEX.finditer(text)]


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, label, before, body, after). The label of a run is whether a pattern covers some of it. What a pattern leaves of a run
    is a candidate of its own if it is as long and mixed as one; it has no label, as it may well be the other half of a pair."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if not _mixed(m.group()):
            continue
        over = sorted((a, b) for _, a, b in spans if a < e and s < b)
        out.append((s, e, bool(over), text[max(0, s - SIDE) : s], m.group(), text[e : e + SIDE]))
        at = s
        for a, b in [*over, (e, e)]:
            if over and a - at >= LEAST and _mixed(text[at:a]):
                out.append((at, a, None, text[max(0, at - SIDE) : at], text[at:a], text[a : a + SIDE]))
            at = max(at, b)
    return out


def _mixed(body: str) -> bool:
    return any(c.isdigit() for c in body) and any(c.isalpha() for c in body)


def _long_runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    fit = ends - starts >= least
    return starts[fit], ends[fit]


def worth_reading(col: pa.Array) -> np.ndarray:
    """Rows that can hold a span or a candidate, told from their bytes; the patterns run over these rows alone."""
    data, off = text_bytes(col)
    at: list[np.ndarray] = [_long_runs(_HEX[data], 24)[0]]
    starts, ends = _long_runs(_SOLID[data], 16)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    at.append(starts[digits[ends] > digits[starts]])
    raw = data.tobytes()
    low = raw.translate(_LOW)
    for word, where in [*((w, low) for w in KEYWORDS), (b"AKIA", raw)]:
        found, i = [], where.find(word)
        while i >= 0:
            found.append(i)
            i = where.find(word, i + 1)
        at.append(np.array(found, np.int64))
    # a run that crosses the end of a row counts for every row that it touches
    return np.unique(np.concatenate([np.searchsorted(off, np.concatenate(at), side="right") - 1, _touched(off, starts, ends), _touched(off, *_long_runs(_HEX[data], 24))])).astype(np.int64)


def _touched(off: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    a, b = np.searchsorted(off, starts, side="right") - 1, np.searchsorted(off, ends, side="left") - 1
    return np.concatenate([np.arange(x, y + 1) for x, y in zip(a, b) if y > x] or [np.zeros(0, np.int64)]).astype(np.int64)


def _scan(batches: Iterator[pa.RecordBatch], kinds: tuple[pa.DataType, pa.DataType]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "text"):
        col = b.column("text")
        spans: list[list] = [[] for _ in range(b.num_rows)]
        found: list[list] = [[] for _ in range(b.num_rows)]
        for i in worth_reading(col):
            text = col[int(i)].as_py()
            if text:
                spans[i] = base_spans(text)
                found[i] = candidates(text, spans[i])
        rows = [[dict(zip(("kind", "start", "end"), s)) for s in x] for x in spans]
        cand = [[dict(zip(("start", "end", "label", "before", "body", "after"), c)) for c in x] for x in found]
        yield pa.record_batch([*b.columns, pa.array(rows, kinds[0]), pa.array(cand, kinds[1])], names=[*b.schema.names, "_spans", "_candidates"])


_TYPES = (
    pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])),
    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.bool_()), ("before", pa.string()), ("body", pa.string()), ("after", pa.string())])),
)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, _spans, _candidates: one pass over the texts."""
    kept = without(docs.select(*keep), ["text", "_spans", "_candidates"])
    named = docs.select(*kept.columns, F.col(text).cast("string").alias("text"))
    return named.mapInArrow(lambda bs: _scan(bs, _TYPES), f"{_ddl(named)}, _spans {SPANS}, _candidates {CANDIDATES}").drop("text")


# ---- the network


def encode(before: str, body: str, after: str) -> list[np.ndarray]:
    """Windows of character classes: the surroundings and 40 characters of the candidate at a time."""
    code = lambda s, n, right: np.frombuffer((s[-n:].rjust(n, "\0") if right else s[:n].ljust(n, "\0")).encode("utf-32-le"), np.uint32)
    out = []
    for at in range(0, max(len(body), 1), BODY):
        w = np.concatenate([code(before, SIDE, True), code(body[at : at + BODY], BODY, False), code(after, SIDE, False)])
        out.append(np.where(w < 32, 0, np.where(w < 127, w - 31, 96)).astype(np.int64))
    return out


def _forward(p: dict, x: np.ndarray) -> tuple:
    """Embedding, one convolution of width 5 with ReLU, maxima over the candidate and over its surroundings, and a logistic unit."""
    e = p["emb"][x]
    win = np.lib.stride_tricks.sliding_window_view(e, 5, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WIDTH - 4, -1)
    a = np.maximum(win @ p["conv"] + p["bias"], 0)
    body = a[:, SIDE - 2 : SIDE - 2 + BODY]
    side = np.concatenate([a[:, : SIDE - 2], a[:, SIDE - 2 + BODY :]], 1)
    top_body, top_side, mean = body.max(1), side.max(1), body.mean(1)
    z = np.concatenate([top_body, top_side, mean], 1) @ p["out"] + p["out_bias"]
    return e, win, a, body, side, np.concatenate([top_body, top_side, mean], 1), z


def _gradients(p: dict, x: np.ndarray, y: np.ndarray) -> dict:
    e, win, a, body, side, feat, z = _forward(p, x)
    dz = (1 / (1 + np.exp(-z)) - y) / len(x)
    g = {"out": feat.T @ dz + 1e-4 * p["out"], "out_bias": dz.sum()}
    df = np.outer(dz, p["out"])
    n = p["conv"].shape[1]
    db, ds = np.zeros_like(body), np.zeros_like(side)
    np.put_along_axis(db, body.argmax(1)[:, None, :], df[:, None, :n], 1)
    np.put_along_axis(ds, side.argmax(1)[:, None, :], df[:, None, n : 2 * n], 1)
    db += df[:, None, 2 * n :] / BODY
    da = np.concatenate([ds[:, : SIDE - 2], db, ds[:, SIDE - 2 :]], 1) * (a > 0)
    g["conv"] = np.tensordot(win, da, ([0, 1], [0, 1]))
    g["bias"] = da.sum((0, 1))
    dwin = (da @ p["conv"].T).reshape(len(x), WIDTH - 4, 5, -1)
    de = np.zeros_like(e)
    for k in range(5):
        de[:, k : k + WIDTH - 4] += dwin[:, :, k]
    g["emb"] = np.zeros_like(p["emb"])
    np.add.at(g["emb"], x, de)
    return g


def _descend(pos: list[tuple], neg: list[tuple], steps: int, rng: np.random.Generator) -> dict:
    both = pos + neg
    p = {"emb": rng.normal(0, 0.3, (97, 8)), "conv": rng.normal(0, 0.15, (40, 16)), "bias": np.zeros(16), "out": rng.normal(0, 0.1, 48), "out_bias": 0.0}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    windows = lambda rows: [encode(*r)[int(rng.integers(0, -(-len(r[1]) // BODY) or 1))] for r in rows]
    for t in range(1, steps + 1):
        pick = [(pos[i], 1.0) for i in rng.integers(0, len(pos), 32)] + [(neg[i], 0.0) for i in rng.integers(0, len(neg), 32)]
        rows = []
        for (before, body, after), _ in pick:
            if rng.random() < 0.5:
                before, _, after = both[rng.integers(0, len(both))]
            rows.append((before, body, after))
        g = _gradients(p, np.array(windows(rows)), np.array([y for _, y in pick]))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] * g[k]
            p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return p


def fit(positive: list[tuple], negative: list[tuple], recall: float = 0.99, steps: int = 400, seed: int = 5) -> dict | None:
    """Train on (before, body, after) of secrets and of harmless candidates; None unless there are five different ones of both."""
    positive, negative = list(dict.fromkeys(positive)), list(dict.fromkeys(negative))
    if min(len(positive), len(negative)) < 5:
        return None
    rng = np.random.default_rng(seed)
    rules = {True: split_rule(positive), False: split_rule(negative)}
    split = lambda rows, rule: ([r for r in rows if not held_out(r, rule)], [r for r in rows if held_out(r, rule)])
    (pos, pos_held), (neg, neg_held) = split(positive, rules[True]), split(negative, rules[False])
    # some without a label are secrets that the patterns miss: the highest of a short first training are not trained on as harmless
    z = _logits(_descend(pos, neg, steps // 4, rng) | {"scale": 1.0, "shift": 0.0}, neg)
    neg = [neg[i] for i in np.argsort(z, kind="stable")[: int(np.ceil(harmless(len(neg)) * len(neg)))]]
    p = _descend(pos, neg, steps, rng)
    p |= {"scale": 1.0, "shift": 0.0, "threshold": 0.0, "rules": rules}
    zp, zn = _logits(p, pos_held), _logits(p, neg_held)
    z, y = np.concatenate([zp, zn]), np.concatenate([np.full(len(zp), 1 - 1 / (len(zp) + 2)), np.full(len(zn), 1 / (len(zn) + 2))])
    unit = max(float(np.abs(z).mean()), 1e-6)
    a, b = 1.0, 0.0
    for _ in range(300):  # logistic calibration, with targets drawn in by the size of the sample; 1/4 bounds the curvature, so steps only descend
        q = 1 / (1 + np.exp(-np.clip(a * z / unit + b, -500, 500)))
        u = np.stack([z / unit, np.ones(len(z))])
        a, b = np.array([a, b]) - np.linalg.solve(u @ u.T / 4 + 1e-3 * np.eye(2), u @ (q - y))
    a /= unit
    return p | {"scale": a, "shift": b, "threshold": threshold(*(np.unique(bins(a * x + b), return_counts=True) for x in (zp, zn)), recall)}


def _place(row: tuple, whole: bool) -> int:
    return zlib.crc32("\0".join((row[0], row[1][:LONGEST], row[2]) if whole else (row[1][:LONGEST],)).encode())


def split_rule(rows: list[tuple]) -> tuple[bool, int]:
    """Which candidates are held out: those whose text has a hash in the lowest fifth. Where that leaves one side empty, the
    lowest fifth of the hashes at hand; where there is one text only, its surroundings are hashed as well."""
    whole = len({r[1][:LONGEST] for r in rows}) < 2
    places = sorted({_place(r, whole) for r in rows})
    fifth = (1 << 32) // 5
    return whole, fifth if places[0] <= fifth < places[-1] else places[(len(places) - 1) // 5]


def held_out(row: tuple, rule: tuple[bool, int]) -> bool:
    return _place(row, rule[0]) <= rule[1]


def bins(z: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(z, -FAR, FAR) * UNIT).astype(np.int64)


def harmless(n: int) -> float:
    """The share of n candidates without a label that counts as harmless: all but the highest tenth of a few, five of up to 400, and one in 80 of more."""
    return max(0.9, 1 - 5 / min(n, 400))


def threshold(positive: tuple[np.ndarray, np.ndarray], negative: tuple[np.ndarray, np.ndarray], recall: float) -> float:
    """From the bins of held-out scores, ascending, and their counts."""
    (zp, kp), (zn, kn) = positive, negative
    at = lambda z, k, share: z[np.searchsorted(np.cumsum(k), int(np.floor(share)), side="right")]
    low = at(zp, kp, (1 - recall) * kp.sum()) / UNIT
    high = (at(zn, kn, harmless(kn.sum()) * (kn.sum() - 1)) + 1) / UNIT
    return float(low if high >= low else (low + high) / 2)


def _logits(p: dict, rows: list[tuple]) -> np.ndarray:
    """Calibrated log odds of every candidate: the highest of its windows."""
    out = np.full(len(rows), -np.inf)
    x, of = [], []
    for i, r in enumerate(rows):
        for w in encode(*r):
            x.append(w)
            of.append(i)
    for at in range(0, len(x), 1024):
        z = _forward(p, np.array(x[at : at + 1024]))[-1] * p["scale"] + p["shift"]
        np.maximum.at(out, of[at : at + 1024], z)
    return out


def _few(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows, in batches whose candidates have about ``limit`` bytes."""
    for b in batches:
        share = max(1, int(limit * b.num_rows / max(1, b.nbytes)))
        for at in range(0, b.num_rows, share):
            yield b.slice(at, share)


def _held_scores(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    """label, a hash of the candidate and the bin of its score, for every labelled candidate that is held out."""
    for b in _few(batches):
        every = dict.fromkeys((c["label"], c["before"], c["body"], c["after"]) for r in b.column("_candidates").to_pylist() for c in r or [] if c["label"] is not None)
        rows = [c for c in every if held_out(c[1:], model["rules"][c[0]])]
        key = [int.from_bytes(hashlib.blake2b("\0".join(c[1:]).encode(), digest_size=8).digest(), "big", signed=True) for c in rows]
        yield pa.record_batch({"label": pa.array([c[0] for c in rows], pa.bool_()), "key": pa.array(key, pa.int64()), "bin": pa.array(bins(_logits(model, [c[1:] for c in rows])), pa.int64())})


def train(scanned: DataFrame, sample: int = 2000, recall: float = 0.99) -> dict | None:
    """At most ``sample`` different labelled candidates of each label reach the driver, chosen by a hash of their text, and the
    counts of the scores of all that are held out (at most 32,769 bins of each label)."""
    c = scanned.select(F.explode("_candidates").alias("c")).select(F.col("c.label").alias("label"), F.col("c.before").alias("before"), F.expr(f"substring(c.body, 1, {LONGEST})").alias("body"), F.col("c.after").alias("after"))
    take = lambda label: [tuple(r) for r in c.where(F.col("label") == label).select("before", "body", "after").distinct().orderBy(F.xxhash64("before", "body", "after"), "before", "body", "after").limit(sample).collect()]
    model = fit(take(True), take(False), recall)
    if model is None:
        return None
    sent = scanned.sparkSession.sparkContext.broadcast(model)
    scores = scanned.select("_candidates").mapInArrow(lambda bs: _held_scores(bs, sent.value), "label boolean, key long, bin long")
    counted = scores.groupBy("label", "key").agg(F.max("bin").alias("bin")).groupBy("label", "bin").agg(F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    of = lambda label: tuple(np.array([r[k] for r in counted if r.label == label], np.int64) for k in ("bin", "n"))
    return model | {"threshold": threshold(of(True), of(False), recall)}


def added(model: dict | None, rows: list[dict]) -> np.ndarray:
    """Which candidates the network takes for secrets; those that a pattern covers are left to the pattern."""
    if model is None or not rows:
        return np.zeros(len(rows), bool)
    out = np.zeros(len(rows), bool)
    free = [i for i, r in enumerate(rows) if not r["label"]]
    out[free] = _logits(model, [(rows[i]["before"], rows[i]["body"], rows[i]["after"]) for i in free]) >= model["threshold"]
    return out


def _join(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0], x[2])))


def _report(batches: Iterator[pa.RecordBatch], model: dict | None) -> Iterator[pa.RecordBatch]:
    for b in _few(batches):
        base = [[(x["kind"], x["start"], x["end"]) for x in r or []] for r in b.column("_spans").to_pylist()]
        cand = b.column("_candidates").to_pylist()
        flat = [(i, c) for i, r in enumerate(cand) for c in r or []]
        every = [list(x) for x in base]
        for (i, c), yes in zip(flat, added(model, [c for _, c in flat])):
            if yes:
                every[i].append((3, c["start"], c["end"]))
        n = lambda kind: pa.array([sum(x[0] == kind for x in r) for r in base], pa.int64())
        kept = b.columns[:-2]
        made = [n(0), n(1), n(2), pa.array([hashlib.sha256(_join(r).encode()).hexdigest() for r in base]), pa.array([_join(r) for r in every], pa.string())]
        yield pa.record_batch([*kept, *made], names=[*b.schema.names[:-2], "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def report(scanned: DataFrame, model: dict | None) -> DataFrame:
    """The kept columns, the counts of each pattern, base_sha256 and all spans."""
    sent = scanned.sparkSession.sparkContext.broadcast(model)
    kept = scanned.drop("_spans", "_candidates")
    return scanned.mapInArrow(lambda bs: _report(bs, sent.value), f"{_ddl(kept)}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def find(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), sample: int = 2000, recall: float = 0.99) -> DataFrame:
    found = stored(scan(docs, text, keep), "secrets")
    return report(found, train(found, sample, recall))


def _redact(batches: Iterator[pa.RecordBatch], model: dict | None, mark: str) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "text"):
        col, at = b.column("text"), b.schema.get_field_index("text")
        texts = col.to_pylist()
        for i in worth_reading(col):
            text = texts[i]
            if not text:
                continue
            base = base_spans(text)
            cand = [dict(zip(("start", "end", "label", "before", "body", "after"), c)) for c in candidates(text, base)]
            spans = sorted([(s, e) for _, s, e in base] + [(c["start"], c["end"]) for c, yes in zip(cand, added(model, cand)) if yes])
            out, done = [], 0
            for s, e in spans:
                if s >= done:
                    out += [text[done:s], mark]
                done = max(done, e)
            texts[i] = "".join([*out, text[done:]]) if spans else text
        cols = list(b.columns)
        cols[at] = pa.array(texts, pa.string())
        yield pa.record_batch(cols, names=b.schema.names)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", sample: int = 2000, recall: float = 0.99) -> DataFrame:
    """The documents with every span replaced by ``mark``; all columns stay, whatever their names."""
    found = stored(scan(docs, text, ()), "secrets")
    sent = docs.sparkSession.sparkContext.broadcast(train(found, sample, recall))
    names = docs.columns
    plain = docs.toDF(*["text" if n == text else f"c{i}" for i, n in enumerate(names)])
    return plain.mapInArrow(lambda bs: _redact(bs, sent.value, mark), _ddl(plain)).toDF(*names)
