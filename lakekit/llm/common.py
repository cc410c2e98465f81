"""What the operators of this subpackage share: reading columns, written intermediate tables, numpy views of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import workdir

#: Words are runs of anything but these six characters.
WHITE = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: later uses neither compute it again nor depend on an executor.

    Once it is written, the shuffle files that it was made from are of no use; Spark is told to delete them at the end of the write
    instead of when the driver next collects its garbage, so that a job of many steps holds the files of one at a time.
    """
    spark, path = df.sparkSession, workdir(df.sparkSession, label)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a ``stored`` table that a later one has taken the place of."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; an id that is NULL counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def words(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), WORD_BREAK), lambda w: w != "")


def pieces(batches: Iterator[pa.RecordBatch], text: str | None = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text (one longer text is a batch of its own), so that
    arrays with an entry per byte stay small whatever the size of an Arrow batch."""
    for b in batches:
        if not b.num_rows:
            continue
        if text is None:
            yield b
            continue
        ends = offsets(b.column(text))[1:]
        start, base = 0, int(offsets(b.column(text))[0])
        while start < b.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield b.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def offsets(col: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array: one more than rows. A NULL has the length 0 (Arrow leaves what stands there open, so it is cut)."""
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    raw = np.frombuffer(col.buffers()[1], dtype=np.int64 if large else np.int32)[col.offset : col.offset + len(col) + 1]
    return raw.astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows joined, offsets from 0); NULL is empty."""
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    off = offsets(col)
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_ODD, _ODD_INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in WHITE]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of ``data``; equal spans hash alike wherever they stand (polynomial prefix sums)."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the words of every row."""
    inside = np.ones(len(data) + 1, bool)
    inside[:-1] = ~_SPACE[data]
    inside[-1] = False
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last = inside[:-1] & ~inside[1:]
    edges = off[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    both = edges[inside[edges] & inside[edges - 1]]  # a row ends and the next begins within a run
    first[both] = True
    last[both - 1] = True
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, side="right") - 1


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words of every row, A-Z lower-cased."""
    data, off = text_bytes(col)
    data = _LOWER[data]
    starts, ends, row = word_spans(data, off)
    return span_hashes(data, starts, ends), row


def runs(a: np.ndarray) -> np.ndarray:
    """Start of every run of equal values in a sorted array."""
    return np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)


def by_schema(rows: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(rows[f.name], f.type) if not isinstance(rows[f.name], (pa.Array, pa.ChunkedArray)) else rows[f.name].cast(f.type) for f in schema], schema=schema)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns of ``df`` whose names clash with ``names``, whatever their case."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])
