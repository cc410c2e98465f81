import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakekit.llm import common, ctw, fixity, graph, jaccard, mixing, topk
from pyspark.sql import functions as F


def lower(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def brute_groups(texts, words):
    """(size of the set, smallest reachable id) for every id, from all pairs that share a shingle."""
    sets, inverted = {}, defaultdict(list)
    for k, t in texts.items():
        w = [lower(x) for x in words(t)]
        sets[k] = frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
        for g in sets[k]:
            inverted[g].append(k)
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in sets.items():
        for o, shared in Counter(o for g in x for o in inverted[g] if o < k).items():
            if 100 * shared >= 85 * (len(x) + len(sets[o]) - shared):
                a, b = find(o), find(k)
                root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in texts}


def check_groups(spark, texts, words):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.groups(df).collect()}
    assert got == brute_groups(texts, words)


def test_groups_of_documents(spark, docs, words):
    check_groups(spark, {k: d.text for k, d in docs.items()}, words)


@pytest.mark.parametrize("length, edits", [((4, 30), 1), ((60, 120), 3)])
def test_groups_of_edited_copies(spark, words, length, edits):
    """Families of copies of copies: links form chains, and most pairs of a family are near the threshold. Every
    member shares most shingles with its family, so lists are longer than the least frequent count."""
    rnd, texts = random.Random(length[0]), {}
    for family in range(8):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(*length))]
        for _ in range(45):
            w = list(base)
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = f"w{rnd.randint(0, 400)}"
            if rnd.random() < 0.3:
                base = w
            texts[len(texts)] = " ".join(w)
    check_groups(spark, texts, words)


def test_passage_shared_by_many(spark, words):
    rnd = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(55))
    text = lambda n: " ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(n))
    check_groups(spark, {i: f"{text(rnd.randint(1, 40))} {passage} {text(rnd.randint(1, 40))}" for i in range(150)}, words)


def test_subsets_meet_exactly_when_sets_are_linked():
    rnd = random.Random(5)
    for _ in range(500):
        n = rnd.randint(6, 22)
        x = {rnd.getrandbits(60) for _ in range(n)}
        y = set(rnd.sample(sorted(x), n - rnd.randint(0, 2))) | {rnd.getrandbits(60) for _ in range(rnd.randint(0, 2))}
        a, b = (np.sort(np.array(list(s), np.uint64)) for s in (x, y))
        linked = 100 * len(x & y) >= 85 * len(x | y)
        meet = len(b) in jaccard.partners(len(a)) and bool(set(jaccard.subsets(a, len(b)).tolist()) & set(jaccard.subsets(b, len(a)).tolist()))
        assert linked == meet


def test_linked_sets_meet_in_a_list():
    rnd = random.Random(6)
    for _ in range(300):
        pool = [rnd.getrandbits(64) for _ in range(rnd.randint(8, 80))]
        often = np.sort(np.array([h >> 16 for h in pool if rnd.random() < 0.5] + [1], np.uint64))
        x, y = ({h for h in pool if rnd.random() < 0.95} for _ in range(2))
        if 100 * len(x & y) >= 85 * len(x | y):
            a, b = (set(jaccard.in_order(np.sort(np.array(list(s), np.uint64)), often)[0].tolist()) for s in (x, y))
            assert a & b


def test_boundary_follows_the_sizes():
    assert jaccard.boundary({8: 1000}) >= 8
    assert jaccard.boundary({60: 1000}) == 0


def test_frequent_shingles_are_counted_over_all(spark):
    rows = [(i, "a b c d e " + f"x{i} y{i} z{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    often = jaccard.frequent(df, 10**6)
    want = jaccard.sets_of(pa.array(["a b c d e"]))[0] >> np.uint64(16)
    assert sorted(often.tolist()) == sorted(want.tolist())
    assert len(jaccard.frequent(df, 10**6, most=1)) == 0


def test_groups_on_rows(spark, edges, empty):
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(edges).collect() if r.doc_id)
    assert len(got) == 9
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.groups(edges).collect()}
    assert rows[1] == rows[3][:0] + (0, 1) and rows[2] == (0, 2) and rows[4] == (1, 4)
    assert rows[5] == (9, 5) and rows[None] == (9, 5) and rows[7][0] == 5
    assert jaccard.groups(empty).collect() == []
    kept = jaccard.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, i) for i in (1, 2, 3, 4, 5, 6, 7, 8)]
    assert jaccard.keep_one(empty).collect() == []


def test_one_stays_of_rows_that_share_an_id(spark):
    rows = [(1, "a b c d e f g h i j"), (1, "A b c d e f g h i j"), (1, "q w e r t y u i o"), (None, "a b c d e f g h i j"), (3, "q w e r t y u i o"), (None, "other thing here now then"), (None, "other thing here now then"), (9, "solo words")]
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text.lower()) for r in got) == [(0, "other thing here now then"), (1, "a b c d e f g h i j"), (1, "q w e r t y u i o"), (9, "solo words")]


def test_near_copies_of_the_stage(spark, words):
    """Five words and four fifths: four scattered words or a block of fifteen changed among 200 is a near copy, though not by the rule of the query."""
    import corpus_pipeline

    text = lambda changed, name: " ".join(f"{name}x{i}" if i in changed else f"{name}{i}" for i in range(200))
    rows = [(1, text((), "a")), (2, text((30, 70, 110, 150), "a")), (3, text((), "b")), (4, text(range(90, 105), "b")), (5, text((), "c")), (6, text((20, 50, 80, 110, 140, 170), "c"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, df, "").collect()) == [1, 3, 5, 6]
    assert sorted(r.doc_id for r in jaccard.keep_one(df).collect()) == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("length, edits", [((6, 30), 1), ((60, 120), 3)])
def test_groups_under_another_rule(spark, words, length, edits):
    """Five words and 80 of 100 against all pairs, on families of copies of copies with light and heavy sets."""
    rnd, texts = random.Random(length[0]), {}
    for family in range(6):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(*length))]
        for _ in range(30):
            w = list(base)
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = f"w{rnd.randint(0, 400)}"
            texts[len(texts)] = " ".join(w)
            base = w if rnd.random() < 0.3 else base
    rule = jaccard.Rule(5, 80)
    sets = {k: frozenset(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for k, t in texts.items()}
    root = {k: k for k in texts}
    for _ in texts:
        before = dict(root)
        for a in texts:
            for b in texts:
                if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), rule=rule).collect()}
    assert got == {k: (len(sets[k]), root[k]) for k in texts}


def test_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(300)] + [(rnd.randint(2000, 2400), rnd.randint(2000, 2400)) for _ in range(250)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {k: find(k) for k in list(root)}
    alone = {a for a, b in links if a == b}
    for chunk in (1 << 18, 40):  # all links in one chunk, and rounds over many
        got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long"), chunk).collect()}
        assert {k: v for k, v in want.items() if k not in alone or k in got} == got
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- vectors


def brute_top(rows, k, is_query):
    fine = [(i, [math.floor(1024 * np.float32(x).item()) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, q) in enumerate(fine):
        if i is not None and is_query(i):
            best = sorted((-dot(q, v), math.inf if j is None else j) for m, (j, v) in enumerate(fine) if m != n)[:k]
            out += [(i, r + 1, None if j == math.inf else j, max(min(-s, 2**63 - 1), -(2**63))) for r, (s, j) in enumerate(best)]
    return sorted(out, key=str)


def test_top_k_against_brute_force(spark):
    rnd = np.random.default_rng(4)
    skew = np.exp(-np.arange(24) / 4)
    rows = [(i, (rnd.normal(size=24) * skew).tolist()) for i in range(600)] + [(i, rnd.integers(-2, 3, 24).astype(float).tolist()) for i in range(600, 900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("id") % 50 == 0, k=7, query_rows=5, block_rows=64).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(rows, 7, lambda i: i % 50 == 0)


def test_top_k_on_rows(spark):
    rows = [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (200, None), (300, [1.0, None]), (400, [float("nan"), 1.0]), (5, [float("inf")]), (6, []), (7, [0.5]), (8, [1.0, 2.0, 3.0]), (None, [4.0, 4.0]), (9, [-0.0001, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("ID", F.lit(1))
    got = topk.top_k(df, F.col("id") % 100 == 0, k=10).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(rows, 10, lambda i: i % 100 == 0)
    assert topk.top_k(df.where("false"), F.col("id") % 100 == 0).collect() == []
    huge = [(100, [3e38]), (1, [3e38]), (2, [-3e38]), (3, [1.0])]
    got = topk.top_k(spark.createDataFrame(huge, "vec_id long, embedding array<float>"), F.col("id") == 100).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(huge, 10, lambda i: i == 100)


# ---- context trees


def brute_tree(train, texts, depth):
    counts = defaultdict(lambda: [0, 0])
    bytes_of = lambda t: list((t or "").encode()) + [0]
    nodes = lambda b: [((1 << j) | (b >> (8 - j)), (b >> (7 - j)) & 1) for j in range(8)]
    for t in train:
        h = [0] * depth
        for b in bytes_of(t):
            for d in range(depth + 1):
                for node, bit in nodes(b):
                    counts[tuple(h[len(h) - d :]), node][bit] += 1
            h = h[1:] + [b]
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
    kids, weighted = defaultdict(list), {}
    for c, node in list(counts):
        if c:
            kids[c[1:], node].append((c, node))
    for key in sorted(counts, key=lambda k: -len(k[0])):
        own = kt(*counts[key])
        weighted[key] = own if len(key[0]) == depth else np.logaddexp(own, sum(weighted[k] for k in kids[key])) - math.log(2)

    def one(h, node, d):
        key = tuple(h[len(h) - d :]), node
        zeros, ones = counts.get(key, (0, 0))
        p = (ones + 0.5) / (zeros + ones + 1)
        if d == depth:
            return p
        stop = math.exp(kt(zeros, ones) - math.log(2) - weighted[key]) if key in weighted else 0.5
        return stop * p + (1 - stop) * one(h, node, d + 1)

    out = []
    for t in texts:
        h, score = [0] * depth, 0.0
        for b in bytes_of(t):
            for node, bit in nodes(b):
                p = one(h, node, 0)
                score += math.log10(p if bit else 1 - p)
            h = h[1:] + [b]
        out.append(score)
    return out


def test_tree_scores_and_base(spark, docs, words):
    rows = [(k, d.text[:400]) for k, d in docs.items() if d.text][:40] + [(1000, ""), (1001, None)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in ctw.score(df, common.fold("doc_id", 7) == 2, depth=3, block_bytes=2000).collect()}
    train = [t for i, t in rows if not held(i)]
    for (i, t), want in zip(rows, brute_tree(train, [t for _, t in rows], 3)):
        assert got[i].held_out == held(i)
        assert abs(got[i].score - want) < 1e-8 * abs(want)
        assert abs(got[i].bits_per_byte * len((t or "").encode() + b"0") + want / math.log10(2)) < 1e-6
    seen = Counter()
    for t in train:
        seen.update([*map(lower, words(t)), None])
    total = sum(seen.values())
    for i, t in rows:
        tokens = [*map(lower, words(t)), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(seen[x] > 0 for x in tokens), total)
        assert abs(r.base_score - sum(math.log10((seen[x] + 1) / (total + len(seen) + 1)) for x in tokens)) < 1e-9


def test_merge_over_many_blocks(spark, docs):
    """More blocks than one merge takes."""
    df = spark.createDataFrame([(k, d.text) for k, d in docs.items()], "doc_id long, text string")
    score = lambda size: {r.doc_id: r.score for r in ctw.score(df, F.col("doc_id") % 3 == 0, depth=2, block_bytes=size).collect()}
    many, one = score(2500), score(1 << 30)
    assert many.keys() == one.keys() and all(abs(many[k] - one[k]) < 1e-9 * abs(one[k]) for k in one)


def test_tree_on_rows(edges, empty):
    rows = ctw.score(edges, F.col("doc_id") == 6).collect()
    assert len(rows) == 10 and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert ctw.score(empty, F.lit(False)).collect() == []
    blank = ctw.score(edges, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in blank} == {(0, 0)}
    assert all(abs(r.bits_per_byte - 8) < 1e-9 for r in blank)


# ---- mixture


def brute_fill(budget, caps, weights):
    """Hand out in proportion, cap, and hand the rest to those with room, until nothing moves."""
    got, open_ = {k: 0.0 for k in caps}, {k for k in caps if weights[k] > 0 and caps[k] > 0}
    budget = min(budget, sum(caps[k] for k in open_))
    while budget > 1e-9 and open_:
        w = sum(weights[k] for k in open_)
        step = min(min((caps[k] - got[k]) / weights[k] for k in open_), budget / w)
        for k in open_:
            got[k] += step * weights[k]
        budget -= step * w
        open_ = {k for k in open_ if caps[k] - got[k] > 1e-9}
    return got


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = {("a", "en", "s1"): 100, ("a", "en", "s2"): 1000, ("a", "de", "s1"): 50, ("b", "en", "s1"): 5000, ("b", "fr", None): 10, (None, "en", "s9"): 700}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    weights = {"domain": "case domain when 'a' then 3 when 'b' then 1 else 2 end", "lang": "case lang when 'en' then 2 else 1 end"}
    dw, lw = {"a": 3, "b": 1, None: 2}, {"en": 2}
    for total in (0, 7, 600, 3000, 9000, 10**6):
        got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(df, total, weights, 2).collect()}
        cap = lambda prefix: sum(2 * v for k, v in leaves.items() if k[: len(prefix)] == prefix)
        share, want = {(): total}, {}
        for level in range(3):
            now = {}
            for parent, b in share.items():
                kids = {k[: level + 1] for k in leaves if k[:level] == parent}
                w = {k: (dw[k[0]], lw.get(k[-1], 1), 1)[level] for k in kids}
                now |= brute_fill(b, {k: cap(k) for k in kids}, w)
            share = now
        for k, v in share.items():
            assert abs(got[k] - v) <= 6, (total, k, got[k], v)
        assert sum(got.values()) <= total


def test_prefix_of_epochs(spark):
    rows = [(i, "w " * (1 + i % 5), "en", f"src{i % 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.c0: r for r in mixing.choose(df, 700, "'d'", epochs=3, seed=7).collect()}
    import hashlib

    for source in (0, 1):
        leaf = [(i, 1 + i % 5) for i in range(300) if i % 2 == source]
        size, budget = sum(n for _, n in leaf), 350
        epochs, rest = divmod(budget, size)
        order = sorted(leaf, key=lambda x: (hashlib.md5(f"7:{epochs}:{x[0]}".encode()).hexdigest(), str(x[0])))
        upto = np.cumsum([n for _, n in order])
        for (i, _), u in zip(order, upto):
            copies = epochs + (u <= rest)
            assert (got[i]._copies if i in got else 0) == copies


def test_mixture_on_rows(edges, empty):
    got = mixing.mix(edges, 1.0, "coalesce(substring(source, 1, 4), 'none')", epochs=2)
    assert got.columns == edges.columns
    rows = got.collect()
    assert rows and not {r.doc_id for r in rows} & {1, 2, 3}
    assert mixing.mix(empty, 1.0, "source").collect() == [] and mixing.mix(edges, 0, "source").collect() == []


# ---- fixity


def records(spark, rows):
    return spark.createDataFrame(rows, "file string, offset long, record_id string, content string")


def test_audit_finds_what_differs(spark):
    rnd = random.Random(8)
    rows = [(f"f{i % 3}", 1000 * i, f"r{i}", "x" * rnd.randint(0, 50) + str(i)) for i in range(600)]
    other = [r for r in rows if r[2] not in ("r17", "r400")]
    other = [(*r[:3], r[3] + "!") if r[2] in ("r5", "r599") else r for r in other] + [("f1", 10**9, "late", "z"), ("f9", 0, "new file", "z")]
    got = {(r.file, r.offset, r.record_id, r.status) for r in fixity.audit(records(spark, rows), records(spark, other), span=3000, fan=3).collect()}
    assert got == {("f2", 17000, "r17", "missing"), ("f1", 400000, "r400", "missing"), ("f2", 5000, "r5", "changed"), ("f2", 599000, "r599", "changed"), ("f1", 10**9, "late", "extra"), ("f9", 0, "new file", "extra")}
    assert fixity.audit(records(spark, rows), records(spark, rows)).collect() == []


def test_descent_meets_only_what_differs(spark):
    rows = [("f", 100 * i, f"r{i}", str(i)) for i in range(1000)]
    a, b = (fixity.digests(records(spark, x), span=1000) for x in (rows, [*rows[:500], (*rows[500][:3], "bad"), *rows[501:]]))
    one, two = (fixity.tree(x, 3, 5) for x in (a, b))
    assert [t.count() for t in one] == [100, 20, 4, 1]
    bad = fixity._differ(one[-1], two[-1])
    for x, y in zip(one[-2::-1], two[-2::-1]):
        below = fixity._below(x, bad, 5)
        assert below.count() <= 5
        bad = fixity._differ(below, fixity._below(y, bad, 5))
        assert bad.count() == 1
    assert bad.first().node == 50


def test_audit_on_rows(spark):
    rows = [(None, None, None, None), ("f", 0, "a", ""), ("f", 0, "a", "twice"), ("f", 0, "a", "twice"), ("f", 5, None, "long " * 200_000)]
    none = spark.createDataFrame([], "file string, offset long, record_id string, content string")
    a = records(spark, rows).withColumn("DIGEST", F.lit(1))
    assert fixity.audit(a, records(spark, rows[::-1])).collect() == []
    assert {r.status for r in fixity.audit(a, none).collect()} == {"missing"} and fixity.audit(a, none).count() == 5
    assert [r.status for r in fixity.audit(a, records(spark, rows[:3] + rows[4:])).collect()] == ["missing"]
    assert fixity.audit(none, none).collect() == []


def test_different_sets_of_one_name(spark, words):
    """With names of 6 bits nearly all sets share theirs with others; the groups stay those of the sets."""
    r = random.Random(21)
    base = [[f"w{r.randrange(300)}" for _ in range(40)] for _ in range(40)]
    texts = [" ".join(b) for b in base] + [" ".join(b[:-1]) for b in base[:20]] + [" ".join(b) for b in base[:5]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    get = lambda rule: sorted(tuple(x) for x in jaccard.groups(df, rule=rule).collect())
    few = jaccard.RULE._replace(node_bits=6)
    assert get(few) == get(jaccard.RULE) and len(jaccard.Join(df, rule=few).moved) > 5
    kept = sorted(x.doc_id for x in jaccard.keep_one(df, rule=few).collect())
    assert kept == list(range(40))


def test_counts_beyond_two_bytes():
    h = np.repeat(np.array([3 << 40, 9 << 50, 11 << 58], np.uint64), [200_000, 1, 65_535])
    g = jaccard._gaps([h], 32)
    got = jaccard._frequent(pa.Table.from_batches([g]).slice(0, 1), 2)
    assert got.to_pydict() == {"h": [3 << 24], "n": [200_000]}


def test_large_groups_that_meet_in_a_list_make_few_pairs(spark):
    """Two groups of forty sets and a single one, alike by sketch, in two lists: by turns four pairs of two groups at most, then all that is apart."""
    e = spark.range(81).select(F.explode(F.expr("array(1L, 2L)")).alias("h"), F.col("id").alias("node"), F.lit(100).cast("long").alias("n"), F.lit(0).cast("long").alias("place"),
                               F.floor(F.col("id") / 40).alias("root"), *[F.lit(0).cast("long").alias(f"x{k}") for k in range(jaccard.LANES)])
    join = jaccard.Join.__new__(jaccard.Join)
    join.rule = jaccard.RULE
    group = lambda v: v // 40
    for turn in range(2):
        got = join._met(e, turn).collect()
        assert {(group(r.a), group(r.b)) for r in got} == {(0, 1), (0, 2), (1, 2)}
        assert len(got) <= 2 * (4 + 2 + 2)
    assert join._apart(e).distinct().count() == 40 * 40 + 40 + 40
