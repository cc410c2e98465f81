"""Compare registered queries with their DuckDB text.

    python tests/oracle.py [sf dir] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def kind(t: str) -> str:
    t = t.lower()
    for k, names in {"str": ("varchar", "string"), "i64": ("bigint", "long"), "i32": ("integer", "int"), "f64": ("double",), "bool": ("boolean",)}.items():
        if t in names:
            return k
    return t


def canon(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    return repr(v)


def compare(spark, con, fn, sql, sf_dir):
    """None when equal, else a text that says what differs."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    if sql is None:
        return None, len(got)
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want_rows = rel.fetchall()
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}", len(got)
    idx = [names.index(c) for c in cols]
    want = sorted(tuple(canon(r[i]) for i in idx) for r in want_rows)
    types = {n: kind(str(t)) for n, t in zip(names, [d[1] for d in rel.description])}
    mine = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    bad = {c: (mine[c], types[c]) for c in cols if mine[c] != types[c]}
    if got != want:
        a, b = set(got), set(want)
        return f"rows {len(got)} != {len(want)}; only spark {sorted(a - b)[:3]}; only duckdb {sorted(b - a)[:3]}; types {bad}", len(got)
    return (f"types {bad}" if bad else None), len(got)


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from lakekit.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:]) or ("",)
    spark, con, sqls, fails = get_spark(), connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            err, n = compare(spark, con, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            err, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        fails += err is not None
        print(f"{'ok ' if err is None else 'BAD'} {name} rows={n} {time.time() - t:.2f}s {'' if name in sqls else '(rows only)'} {err or ''}", flush=True)
    print("failed:", fails)
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
