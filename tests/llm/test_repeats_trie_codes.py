"""Repeated phrases (11), prefix trie (12) and vector codes (13) against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakekit.llm import codes, phrases, queries, trie

# ---- repeated phrases


def repeats(texts, words, window):
    docs = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def noisy_texts(seed, n=60):
    """Texts over few words, so runs recur by chance; shared passages at any place, exact copies, a passage twice in one text, odd white space."""
    r = random.Random(seed)
    vocab = ["a", "b", "ab", "é", "日本", "😀", "x y", "Word", "word"]
    free = lambda k: [r.choice(vocab) + (str(r.randrange(40)) if r.random() < 0.5 else "") for _ in range(k)]
    passages = [free(r.randrange(5, 90)) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [free(r.randrange(0, 30)) if r.random() < 0.6 else r.choice(passages)[r.randrange(4) :] for _ in range(r.randrange(0, 6))]
        sep = r.choice([" ", "\n", " \t\r\n ", "\x0b"])
        out.append(r.choice(["", " "]) + sep.join(w for p in parts for w in p))
    return out + out[:5] + [out[7]] * 20


@pytest.mark.parametrize("seed,window,anchor,size", [(1, 35, 8, 1 << 21), (2, 12, 4, 700), (3, 5, 5, 300), (4, 9, 1, 1)])
def test_repeats_equal_brute_force(spark, words, seed, window, anchor, size):
    texts = noisy_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in phrases.remove_repeats(df, window=window, anchor=anchor, block_bytes=size).collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, words, window)


def test_spans_are_the_removed_words(spark, words):
    texts = noisy_texts(9)
    rows = phrases.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), window=12, anchor=4).collect()
    for r in rows:
        w = words(texts[r.doc_id])
        gone = {i for s in r.spans for i in range(s.start, s.stop)}
        assert len(gone) == r.n_removed == sum(s.stop - s.start for s in r.spans)
        assert " ".join(x for i, x in enumerate(w) if i not in gone) == r.kept


def test_one_passage_in_most_documents(spark):
    """A third of the rows are one text, and all share a passage: no block gets more than one row of a phrase."""
    shared = " ".join(f"s{i}" for i in range(40))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(f"x {shared} y")).otherwise(F.concat(F.col("id").cast("string"), F.lit(f" {shared} "), F.col("id").cast("string"))).alias("text")).repartition(8)
    got = phrases.remove_repeats(df)
    assert got.where("doc_id % 3 = 0").where("n_removed <> 42 or kept <> ''").isEmpty()
    assert got.where("doc_id % 3 <> 0").where("n_removed <> 40 or kept <> doc_id || ' ' || doc_id").isEmpty()


def test_repeats_on_edges(spark, edges, empty, words):
    got = phrases.remove_repeats(edges, keep=("doc_id", "N_WORDS", "lang"))
    assert got.columns == ["doc_id", "lang", "n_words", "n_removed", "spans", "kept"]
    texts = [r.text for r in edges.collect()]
    assert sorted((r.n_words, r.n_removed, r.kept) for r in got.collect()) == sorted(repeats(texts, words, 35))
    assert phrases.remove_repeats(empty).count() == 0


def test_long_text_alone(spark, words):
    r = random.Random(4)
    w = [f"w{r.randrange(10**6)}" for _ in range(400_000)]
    w[300_000:300_050] = w[100:150]
    got = phrases.remove_repeats(spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")).first()
    assert (got.n_words, got.n_removed, [tuple(s) for s in got.spans]) == (400_000, 100, [(100, 150), (300_000, 300_050)])


def test_least_of():
    key = np.array([5, 3, 9, 1, 7, 7, 2, 8], np.uint64)
    for n in range(1, 9):
        assert list(phrases.least_of(key, n)) == [min(key[i : i + n]) for i in range(len(key) - n + 1)]


# ---- prefix trie


def nodes_of(paths):
    """{conv: tuple of turns} -> rows of the trie."""
    nodes = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes[p[:d]].append(c)
    kids = Counter(n[:-1] for n in nodes if n)
    leaves, saved = Counter(), Counter()
    for n, m in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
    sha = lambda n: hashlib.sha256(",".join(str(c) for c in sorted(nodes[n]) if len(paths[c]) == len(n)).encode()).hexdigest()
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else -1, len(m), kids[n], leaves[n], saved[n], sha(n)) for n, m in nodes.items())


def own_turns(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: tuple((r, x) for _, _, r, x in sorted(v, key=lambda z: z[:2])) for c, v in by.items()}


def rows_of(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*trie.COLUMNS).collect())


def branching(seed, n, longest=9):
    """Conversations that leave each other at any turn; some are copies, some prefixes of others."""
    r = random.Random(seed)
    out = []
    for c in range(n):
        x = 0 if r.random() < 0.4 else r.randrange(4)
        out += [(c * 3 + 1, t, None if r.random() < 0.1 else "user", f"{x}é" if r.random() < 0.8 else r.choice(["", None, str(r.randrange(50))])) for t in range(r.randrange(1, longest))]
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed,n,cells", [(1, 150, None), (2, 150, 8), (3, 400, 256), (4, 1, None)])
def test_trie_equals_brute_force(spark, seed, n, cells):
    """Also with sketches so small that most estimates are too high."""
    rows = branching(seed, n)
    turns = trie.turns_of(spark.createDataFrame(rows, SCHEMA).repartition(4)).withColumnRenamed("pos", "depth")
    lengths = turns.groupBy("conv").agg(F.max("depth").alias("len"))
    assert rows_of(trie.prefix_trie(turns, lengths, cells)) == nodes_of(own_turns(rows))


def test_spliced_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own = own_turns(rows)
    cut = lambda c: zlib.crc32(str(c).encode()) % 9
    assert rows_of(queries.op12(spark, sf)) == nodes_of({c: own.get(c - c % 5, ())[: cut(c)] + o[cut(c) :] for c, o in own.items()})


def test_turnless_and_edge_conversations(spark):
    """NULL ids, turns, roles and texts, repeated rows, a conversation left without turns, clashing extra columns."""
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 5, "user", "b"), (3, 0, None, None), (3, 2, "user", "a"), (7, 0, "user", "z")]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA + ", depth long, K1 string")
    turns = trie.turns_of(df)
    heads = F.when(F.col("conv") == 7, 5).when(F.col("conv") == 3, 1).otherwise(0)
    got = trie.prefix_trie(*trie.spliced(turns, F.when(F.col("conv") == 3, 2).otherwise(99), heads, 5))
    own = own_turns(rows)
    assert rows_of(got) == nodes_of({1: own[1], 2: own[2], 3: own[2][:1] + own[3][1:], 7: ()})
    assert trie.prefix_trie(*trie.spliced(trie.turns_of(df.where("false")), F.col("conv"), F.lit(0), 0)).count() == 0


def test_one_conversation_holds_a_third(spark):
    long = [(0, t, "user", str(t % 7)) for t in range(900)]
    rest = [(c, t, "user", str(t % 7) if t < c % 11 else f"{c} {t}") for c in range(1, 300) for t in range(6)]
    turns = trie.turns_of(spark.createDataFrame(long + rest, SCHEMA)).withColumnRenamed("pos", "depth")
    got = trie.prefix_trie(turns, turns.groupBy("conv").agg(F.max("depth").alias("len")))
    assert rows_of(got) == nodes_of(own_turns(long + rest))


# ---- vector codes


def coded(rows, entries, rounds, parts=4):
    rows = [(i, [math.floor(1024 * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = -(-max((len(v) for _, v, _ in rows), default=0) // parts)
    rows = [(i, v + [0] * (parts * w - len(v)), lab) for i, v, lab in rows]
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((dist(cut(v, p), e), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for _, v, _ in rows:
                mine[near(v, p)[1]].append(cut(v, p))
            for j, vs in mine.items():
                books[p][j] = [sum(c) // len(vs) for c in zip(*vs)]
    fin = [[near(v, p) for p in range(parts)] for _, v, _ in rows]
    errors = [min(sum(d for d, _ in f), codes.TOP) for f in fin]
    total = Counter()
    for (_, _, lab), e in zip(rows, errors):
        total[lab] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(repr((i, "".join(f"{j:02x}" for _, j in f), e, min(total[lab], codes.TOP), sha)) for (i, _, lab), f, e in zip(rows, fin, errors))


VECTORS = "vec_id long, embedding array<double>, label int"


def held(spark, rows, entries, rounds=4, **more):
    got = codes.compress(spark.createDataFrame(rows, VECTORS).repartition(3), entries=entries, rounds=rounds, **more)
    assert sorted(repr(tuple(r)) for r in got.collect()) == coded(rows, entries, rounds)


@pytest.mark.parametrize("seed,entries,most", [(1, 16, 16), (2, 16, 4), (3, 24, 1), (4, 1, 16), (5, 40, 2)])
def test_codes_equal_brute_force(spark, seed, entries, most):
    """Grids of few values, so ties between entries are common, and clusters, so bounds decide most parts."""
    r = random.Random(seed)
    value = (lambda: r.randrange(-2, 3) / 1024) if seed % 2 else (lambda: r.choice([-0.5, 0, 0.5]) + r.random() / 50)
    rows = [(i, [value() for _ in range(8)], r.choice([None, 1, 2])) for i in r.sample(range(1000), 300)]
    held(spark, rows, entries, most=most)


def test_codes_on_edges(spark):
    r = random.Random(6)
    odd = [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] * 8, 1), (None, [0.5] * 8, None), (5, [], 2), (6, [0.25], 2), (6, [0.25], 2), (7, [1.0] * 9, 1)]
    held(spark, odd, 256)
    held(spark, odd + [(10 + i, [r.random() for _ in range(8)], i % 3) for i in range(60)], 8)
    held(spark, [(i, [], None) for i in range(3)], 2)
    held(spark, odd[:4], 256)
    assert codes.compress(spark.createDataFrame([], VECTORS)).count() == 0


def test_components_beyond_doubles(spark):
    """Squared distances over 52 bits are taken in Python's integers."""
    r = random.Random(8)
    big = [3e5, 2.0**45, 1e9 + 1 / 1024]
    held(spark, [(i, [r.choice(big) * r.choice([-1, 1]) + r.randrange(5) for _ in range(4)], i % 2) for i in range(40)], 6, rounds=2)
    held(spark, [(i, [r.choice([1e15, -1e16]) for _ in range(4)], 1) for i in range(12)], 3, rounds=2)


def test_bounds_skip_and_lists_shrink():
    """On clusters that hardly move the bounds leave most parts unseen, and whatever they decide is the nearest entry."""
    rng = np.random.default_rng(1)
    book = rng.integers(-500, 500, (64, 6))
    x = book[rng.integers(0, 64, 5000)] + rng.integers(-20, 20, (5000, 6))
    lists, _ = codes.full(x, book, 8)
    for _ in range(3):
        new = book + rng.integers(-3, 4, book.shape)
        lists = codes._unpack(pa.array(codes._pack(lists), pa.binary()), lists.at.shape[1], lists.at.shape[1])
        lists, depth, _ = codes.assign(x, new, codes.moved(lists, codes._drift(book, new)), False)
        book = new
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (lists.own == d.argmin(1)).all()
        assert (depth == 0).mean() > 0.5
        r = np.sqrt(d)
        assert (lists.upper >= r[np.arange(5000), lists.own]).all()
        assert (lists.lower <= np.take_along_axis(r, lists.at, 1)).all() and (np.diff(lists.lower, axis=1) >= 0).all()
        np.put_along_axis(r, lists.at, np.inf, 1)
        r[np.arange(5000), lists.own] = np.inf
        assert (lists.outer <= r.min(1)).all()
