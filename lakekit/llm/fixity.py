"""Fixity of web archive replicas by Merkle trees over offset ranges.

Records are hashed one by one (SHA-256). A leaf of a file's tree covers ``span`` bytes of offsets and digests the records that start there, in
the order of their offsets; a node above digests its ``fan`` children in order. The trees of two replicas are
compared from the roots down: only children of nodes that differ are looked at, and only the records of leaves that differ are
matched, by file, offset and id. A record is ``changed`` (other content or length), ``missing`` (not in the replica) or ``extra``.

Contents are read once per replica; what is written in between is one digest per record. All groups are bounded: a node has
``fan`` children, a leaf the records of ``span`` bytes. So a file of any size is spread over tasks, and the descent costs joins over
the differing nodes only. The tree is as high as the largest file needs.

NULL content is empty content, a NULL id the empty id, a NULL file or offset a value of its own (offset -1). Of records equal in file, offset and id
those with one digest are taken off first, the others matched in the order of their digests, each with one of the other side. Extra columns are not read; equal replicas, and two empty
ones, give no rows; an empty replica misses every record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import stored

SPAN = 1 << 16
FAN = 16


def response(record_id: Column, url: Column, payload: Column) -> Column:
    """A response record as an archive holds it: header lines, payload, two line ends."""
    p = F.coalesce(payload.cast("string"), F.lit(""))
    lines = ["WARC/1.0", "WARC-Type: response", F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url, F.lit(""))), F.concat(F.lit("WARC-Record-ID: <urn:page:"), record_id.cast("string"), F.lit(">")), F.concat(F.lit("Content-Length: "), F.octet_length(p).cast("string"))]
    return F.concat(*[x for line in lines for x in (F.lit(line) if isinstance(line, str) else line, F.lit("\r\n"))], F.lit("\r\n"), p, F.lit("\r\n\r\n"))


def digests(records: DataFrame, file: str = "file", offset: str = "offset", record_id: str = "record_id", content: str = "content", span: int = SPAN) -> DataFrame:
    """One row per record: its place, length, digest and leaf."""
    c = F.coalesce(F.col(content).cast("binary"), F.lit(b""))
    at = F.coalesce(F.col(offset).cast("long"), F.lit(-1))
    return records.select(F.col(file).cast("string").alias("file"), at.alias("offset"), F.coalesce(F.col(record_id).cast("string"), F.lit("")).alias("record_id"), F.octet_length(c).cast("long").alias("length"), F.sha2(c, 256).alias("digest"), F.floor(at / span).cast("long").alias("node"))


def leaves(records: DataFrame) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("offset", "record_id", "length", "digest")))
    text = F.transform(rows, lambda r: F.concat_ws(":", r["offset"].cast("string"), F.octet_length(r["record_id"]).cast("string"), r["record_id"], r["length"].cast("string"), r["digest"]))
    return records.groupBy("file", "node").agg(F.sha2(F.array_join(text, "\n"), 256).alias("digest"))


def above(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """The level over ``nodes``."""
    kids = F.sort_array(F.collect_list(F.struct("node", "digest")))
    text = F.transform(kids, lambda k: F.concat_ws(":", k["node"].cast("string"), k["digest"]))
    return nodes.select("file", F.floor(F.col("node") / fan).alias("up"), "node", "digest").groupBy("file", "up").agg(F.sha2(F.array_join(text, "\n"), 256).alias("d")).select("file", F.col("up").alias("node"), F.col("d").alias("digest"))


def tree(records: DataFrame, levels: int, fan: int = FAN) -> list[DataFrame]:
    """Levels from the leaves to the roots; each is written, as the comparison reads it in its turn."""
    out = [stored(leaves(records), "leaves")]
    for _ in range(levels):
        out.append(stored(above(out[-1], fan), "nodes"))
    return out


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file, node) where the digests differ or one side has none."""
    b = b.select(F.col("file").alias("f2"), F.col("node").alias("n2"), F.col("digest").alias("d2"))
    j = a.join(b, F.col("file").eqNullSafe(F.col("f2")) & (F.col("node") == F.col("n2")), "full")
    gone = F.col("node").isNull()
    return j.where(~F.col("digest").eqNullSafe(F.col("d2"))).select(F.when(gone, F.col("f2")).otherwise(F.col("file")).alias("file"), F.coalesce("node", "n2").alias("node"))


def _below(level: DataFrame, bad: DataFrame, fan: int) -> DataFrame:
    """The nodes of a level whose parent is in ``bad``."""
    bad = bad.select(F.col("file").alias("f3"), F.col("node").alias("n3"))
    return level.join(bad, F.col("file").eqNullSafe(F.col("f3")) & (F.floor(F.col("node") / fan) == F.col("n3")), "left_semi")


def audit(primary: DataFrame, replica: DataFrame, span: int = SPAN, fan: int = FAN, **columns: str) -> DataFrame:
    """file, offset, record_id, status, length, digest (of the primary), found_length, found (of the replica) for every record that differs."""
    one, two = (stored(digests(x, span=span, **columns), "records") for x in (primary, replica))
    last = one.select("node").union(two.select("node")).agg(F.max("node")).first()[0] or 0
    levels = 0
    while last >= fan**levels:
        levels += 1
    a, b = tree(one, levels, fan), tree(two, levels, fan)
    bad = stored(_differ(a[-1], b[-1]), "differing")
    for x, y in zip(a[-2::-1], b[-2::-1]):
        bad = stored(_differ(_below(x, bad, fan), _below(y, bad, fan)), "differing")
    x, y = _below(one, bad, 1), _below(two, bad, 1)
    turn = F.row_number().over(W.partitionBy("file", "offset", "record_id").orderBy("digest", "length"))
    x, y = (r.select("file", "offset", "record_id", "length", "digest") for r in (x, y))
    x, y = x.exceptAll(y).withColumn("turn", turn), y.exceptAll(x).withColumn("turn", turn).toDF("f2", "o2", "r2", "found_length", "found", "t2")
    j = x.join(y, F.col("file").eqNullSafe(F.col("f2")) & (F.col("offset") == F.col("o2")) & (F.col("record_id") == F.col("r2")) & (F.col("turn") == F.col("t2")), "full")
    gone = F.col("offset").isNull()
    status = F.when(gone, "extra").when(F.col("o2").isNull(), "missing").when((F.col("digest") != F.col("found")) | (F.col("length") != F.col("found_length")), "changed")
    return j.select(F.when(gone, F.col("f2")).otherwise(F.col("file")).alias("file"), F.coalesce("offset", "o2").alias("offset"), F.coalesce("record_id", "r2").alias("record_id"), status.alias("status"), "length", "digest", "found_length", "found").where("status is not null")
