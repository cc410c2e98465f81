"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams (1 to ``longest`` characters, lower-cased, hashed into buckets) of every labelled document: each task
adds up its own documents, and Spark sums (language, bucket) over all. Prediction gathers the broadcast matrix of log
probabilities for the n-grams of a batch and adds them up per text with numpy. The matrix holds languages x buckets numbers and
is the only thing that passes the driver: ``matrix_bytes`` bounds it, by fewer buckets where there are many languages.

A text that is NULL or without a letter is ``und`` with score 0, as is every text if no document can be learned from. Ties go to the
language that sorts first. Training leaves out rows with NULL text or language. Extra columns are not read; repeated rows
count, and are predicted, each for itself; a very long text is worked through in pieces of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import mix, pieces

LETTER = regex.compile(r"\p{L}")
PAD = 0x20


def buckets_of(text: str, longest: int, bits: int) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of the lower-cased text, a space before and after it, a million characters at a time."""
    code = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    step = 1 << 20
    for first in range(0, len(code), step):
        part = code[first : first + step + longest - 1]
        h, got = np.zeros(len(part), np.uint64), []
        for n in range(1, longest + 1):
            size = min(step, len(part) - n + 1)
            if size <= 0:
                break
            h = h[:size] * np.uint64(0x100000001B3) + part[n - 1 : n - 1 + size] + np.uint64(n)
            got.append((mix(h) >> np.uint64(64 - bits)).astype(np.int64))
        yield np.concatenate(got)


def _train(batches: Iterator[pa.RecordBatch], longest: int, bits: int) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            docs[lang] = docs.get(lang, 0) + 1
            mine = counts.setdefault(lang, np.zeros(1 << bits, np.int64))
            for ids in buckets_of(text, longest, bits):
                mine += np.bincount(ids, minlength=1 << bits)
        if len(counts) * 8 << bits > 1 << 28:
            yield from _flush(counts, docs)
    yield from _flush(counts, docs)


def _flush(counts: dict[str, np.ndarray], docs: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for lang, mine in counts.items():
        at = np.flatnonzero(mine)
        yield pa.record_batch({"lang": pa.array([lang] * (len(at) + 1), pa.string()), "bucket": pa.array(np.append(at, -1), pa.int32()), "n": pa.array(np.append(mine[at], docs[lang]), pa.int64())})
    counts.clear()
    docs.clear()


def train(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, bits: int = 16, matrix_bytes: int = 64 << 20) -> dict:
    """{langs, matrix (bucket x language), prior}: log probabilities with add-one smoothing."""
    named = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    langs = named.select("lang").distinct().count()
    while bits > 8 and (langs * 16) << bits > matrix_bytes:
        bits -= 1
    sums = named.mapInArrow(lambda bs: _train(bs, longest, bits), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toArrow()
    names = sorted(set(got.column("lang").to_pylist()))
    place = {x: i for i, x in enumerate(names)}
    m, n_docs = np.ones((1 << bits, len(names))), np.zeros(len(names))
    row, col, n = got.column("bucket").to_numpy(), np.array([place[x] for x in got.column("lang").to_pylist()], int), got.column("n").to_numpy()
    of_docs = row < 0
    n_docs[col[of_docs]] = n[of_docs]
    m[row[~of_docs], col[~of_docs]] += n[~of_docs]
    return {"langs": names, "matrix": np.log(m / m.sum(0)).astype(np.float32) if names else m, "prior": np.log(n_docs / max(n_docs.sum(), 1)) if names else n_docs, "longest": longest, "bits": bits}


def _predict(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    names, prior = model["langs"], model["prior"]
    cols = [np.ascontiguousarray(model["matrix"][:, i]) for i in range(len(names))]
    for b in pieces(batches, "text"):
        best, score = [], []
        for text in b.column("text").to_pylist():
            if not names or not text or not LETTER.search(text):
                best.append("und")
                score.append(0.0)
                continue
            total = prior.copy()
            for ids in buckets_of(text, model["longest"], model["bits"]):
                for i, c in enumerate(cols):
                    total[i] += c[ids].sum(dtype=np.float64)
            at = int(np.argmax(total))
            best.append(names[at])
            score.append(float(1 / np.exp(total - total[at]).sum()))
        rest = [b.column(i) for i in range(b.num_columns - 1)]
        yield pa.record_batch([*rest, pa.array(best, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names[:-1], "lang_pred", "score"])


def predict(docs: DataFrame, model: dict, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred, score (the probability of the language that was chosen)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    named = docs.select(*keep, F.col(text).cast("string").alias("text"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[:-1]], "lang_pred string", "score double"])
    return named.mapInArrow(lambda bs: _predict(bs, sent.value), schema)


def identify(docs: DataFrame, learn: Column, **params) -> DataFrame:
    """Learn from the rows where ``learn`` holds and predict all."""
    return predict(docs, train(docs.where(learn), **params))
