import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from lakekit.llm import common, langid, mixing, pieces_codec as P, quality, secrets, token_trees as T
from pyspark.sql import functions as F


def test_words_and_hashes(words):
    texts = ["a B\tc", None, "", " x ", "é\xa0b c", "日本 A", "A"]
    h, row = common.word_hashes(pa.array(texts))
    flat = [(i, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)) for i, t in enumerate(texts) for w in words(t)]
    assert row.tolist() == [i for i, _ in flat]
    assert len({int(x) for x in h}) == len({w for _, w in flat})
    sliced = pa.array(["skip me", *texts])[1:]
    assert common.word_hashes(sliced)[0].tolist() == h.tolist()


def test_token_trees_follow_edits():
    c, rnd = T.Counter(T._ranks(T.RANKS)), random.Random(3)
    signs = " \n\t'srel abcdeé19., 😀"
    for _ in range(400):
        text = "".join(rnd.choice(signs) for _ in range(rnd.choice([0, 1, 3, 20, 200, 600])))
        tokens, chars, _ = T.grow(text, c)
        assert tokens[1] == len(c.encoding.encode_ordinary(text))
        for _ in range(rnd.randint(1, 6)):
            e = (rnd.randint(-2, len(text) + 3), rnd.choice([0, 1, 5, 50]), "".join(rnd.choice(signs) for _ in range(rnd.choice([0, 0, 1, 3, 30]))))
            start = min(max(e[0], 0), len(text))
            want = text[:start] + e[2] + text[start + e[1] :]
            text, _ = T.apply_edit(text, tokens, chars, e, c)
            assert text == want
            assert tokens[1] == len(c.encoding.encode_ordinary(text)) and chars[1] == len(text)


def test_token_trees_on_rows(spark, edges, empty):
    c = T.Counter(T._ranks(T.RANKS))
    edits = spark.createDataFrame([(5, 2, 0, 3, "ab"), (5, 1, 4, 0, " new"), (1, 1, 0, 9, "x y"), (None, 1, 0, 1, "lost"), (7, 1, 100, 0, None)], "doc_id long, seq int, start int, deleted int, inserted string")
    got = T.edit(T.attach(T.build(edges), edits)).collect()
    assert len(got) == 10
    for r in got:
        assert r.n_tokens == c.count(r.text) and r.char_tree[1] == len(r.text)
    fives = [r.text for r in got if r.doc_id == 5]
    assert len(fives) == 2 and all(t.startswith("ab  newtwo three") for t in fives)
    assert [r.text for r in got if r.doc_id == 1] == ["x y"]
    assert T.edit(T.attach(T.build(empty), edits)).collect() == []


def test_pieces_equal_the_library():
    lib, tables, rnd = sentencepiece.SentencePieceProcessor(model_file=P.MODEL), P.load_model(), random.Random(1)
    texts = ["", "  a b", " ", "a\tb\nc", "\xa0x", "a▁b", "x\x00y", "\x00 \x00a\nb", " \n x", "x  \n\n y  ", "b c\x00", "<s> </s>", "▁▁x", "\n", "a \n", "a" * 50]
    texts += [" " * n for n in range(1, 120)] + [" " * n + "\U0001f601" for n in range(1, 70)]
    texts += ["".join(rnd.choice(" \n\tabcdetheinron.,;(){}=-_#01é日▁\x00😀") for _ in range(rnd.randint(0, 60))) for _ in range(600)]
    ids, off = P.Encoder(tables).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == lib.encode(texts)
    data, ends = P.decoder(tables)(ids, off)
    assert [data[a:b].tobytes().decode() for a, b in zip(ends, ends[1:])] == [t.replace("▁", " ") for t in texts]


def test_pieces_of_a_unigram_model():
    """The same search with scores in place of merges, against all segmentations."""
    names = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca", "▁ab"]
    score = np.array([-2.1, -1.3, -1.7, -1.9, -2.2, -2.6, -3.9, -2.5, -2.05, -3.3])
    starts = {x[:k]: -1 for x in names for k in range(1, len(x) + 1)} | {x: i for i, x in enumerate(names)}
    keys = np.array([P._key(x) for x in starts], np.uint64)
    order = np.argsort(keys)
    t = {"keys": keys[order], "ids": np.array(list(starts.values()))[order], "score": score, "merges": False, "longest": 3}

    def best(w):
        if not w:
            return 0.0
        return max(score[names.index(w[:k])] + best(w[k:]) for k in (1, 2, 3) if w[:k] in names and k <= len(w))

    words = ["▁abca", "▁aabc", "▁cabb", "▁bbbb"]
    ids, size = P.viterbi(t, words)
    for w, part in zip(words, np.split(ids, np.cumsum(size)[:-1])):
        assert "".join(names[i] for i in part) == w
        assert abs(score[part].sum() - best(w)) < 1e-9


def test_words_of_unequal_length_advance_together(monkeypatch):
    lib, tables, rnd = sentencepiece.SentencePieceProcessor(model_file=P.MODEL), P.load_model(), random.Random(8)
    words = sorted({"".join(rnd.choice("abcdetheinron.,é日😀") for _ in range(n)) for n in range(1, 200)}, key=len, reverse=True)
    calls, one = [], P.viterbi
    monkeypatch.setattr(P, "viterbi", lambda t, ws: calls.append(len(ws)) or one(t, ws))
    ids, off = P.Encoder(tables).encode(words)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == lib.encode(words)
    assert len(calls) < 12


def test_keys_in_slots():
    rnd = np.random.default_rng(4)
    keys = np.unique(np.concatenate([np.arange(500), rnd.integers(0, 1 << 63, 5000)]).astype(np.uint64))
    table = P.slots_of(keys)
    assert P.find(table, keys).tolist() == list(range(len(keys)))
    others = np.setdiff1d(rnd.integers(0, 1 << 63, 5000).astype(np.uint64), keys)
    assert (P.find(table, others) == -1).all() and len(P.find(table, keys[:0])) == 0
    full = (np.zeros(16, np.uint64), np.full(16, -1, np.int32), np.uint64(60))
    assert P.find(full, np.zeros(1, np.uint64)).tolist() == [-1]


def test_pieces_on_rows(edges, empty):
    rows = P.encode(edges, keep=("doc_id", "N_WORDS")).collect()
    assert len(rows) == 10 and all(r.round_trip for r in rows if r.ids is not None)
    assert [(r.ids, r.n_tokens) for r in rows if r.doc_id == 2] == [(None, 0)]
    assert [r.ids for r in rows if r.doc_id == 1] == [[]]
    assert P.encode(empty).collect() == []
    back = {(r.doc_id, r.text) for r in P.decode(P.encode(edges)).collect()}
    assert back == {(r.doc_id, r.text and r.text.replace("▁", " ")) for r in edges.collect()}


def test_spans_of_every_document(spark, docs, sf):
    got = {r.doc_id: r for r in secrets.find(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    for i, d in docs.items():
        base = secrets._join(secrets.base_spans(d.text or ""))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(got[i].spans.split(","))


def test_base_spans():
    spans = lambda t: secrets._join(secrets.base_spans(t))
    assert spans("API_KEY: 'abc123' x") == "assign:0:16"
    assert spans("password=abc") == "" and spans("password=abcdef") == "assign:0:15"
    assert spans("é Token=\"" + "0a" * 12 + "\"") == "assign:2:33,hex:9:33"
    assert spans("AKIA" + "B" * 15) == "" and spans("AKIA" + "B" * 16) == "access:0:20"
    assert spans("paſsword=abcdef") == ""  # letters in either case, A to Z alone


def test_rows_worth_reading_miss_nothing(docs):
    texts = [d.text for d in docs.values()] + ["AKIA" + "B" * 16, "x passwd:abcdef", "0a" * 12, "a" * 40, "TOKEN=abcdef", None, ""]
    flagged = set(secrets.worth_reading(pa.array(texts)).tolist())
    for i, t in enumerate(texts):
        if t and (secrets.base_spans(t) or secrets.candidates(t, [])):
            assert i in flagged


def test_network_tells_keys_from_addresses():
    rnd = random.Random(2)
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    mail = lambda: "mail%d.example%d.com" % (rnd.randint(0, 9), rnd.randint(0, 99))
    m = secrets.fit([("token = ", key(), "") for _ in range(200)], [("mrs.smith@", mail(), ", ") for _ in range(200)])
    assert (secrets._logits(m, [("see ", key(), " there") for _ in range(50)]) >= m["threshold"]).mean() > 0.9
    assert (secrets._logits(m, [("write to ", mail(), " now") for _ in range(50)]) >= m["threshold"]).mean() < 0.1
    assert secrets.fit([], []) is None


def test_network_adds_spans_and_base_ones_stay(spark):
    rnd = random.Random(4)
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'take token = "{key()}" and write to box{i}.mail.example.com now') for i in range(60)] + [(100, "see " + key()[:20] + "-" + key()[:19] + " there"), (101, "write to box77.mail.example.com now")]
    got = {r.doc_id: r.spans for r in secrets.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "cnn:4:44" and got[101] == ""
    assert all(got[i].startswith("assign:5:54,hex:14:54") for i in range(60))


def test_sample_and_threshold_see_every_text_once(spark, monkeypatch):
    """Copies of a candidate take one place of the sample; no text is trained on and held out; the threshold holds for all that are held out."""
    rnd = random.Random(6)
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    line = lambda k, i: f'token = "{k}" and write to box{i}.mail.example.com now'
    texts = [line(key(), i) for i in range(300)] + [line("0a" * 20, 1000)] * 3000
    found = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).cache()
    taken, trained = [], []
    fit, gradients = secrets.fit, secrets._gradients
    monkeypatch.setattr(secrets, "fit", lambda p, n, *a: taken.extend((p, n)) or fit(p, n, *a))
    monkeypatch.setattr(secrets, "_gradients", lambda p, x, y: trained.extend(w.tobytes() for w in x[:, secrets.SIDE : -secrets.SIDE]) or gradients(p, x, y))
    m = secrets.train(found, sample=100)
    assert [len(set(x)) for x in taken] == [100, 100]
    body = lambda r: secrets.encode(*r)[0][secrets.SIDE : -secrets.SIDE].tobytes()
    for rows, rule in zip(taken, (m["rules"][True], m["rules"][False])):
        held = {body(r) for r in rows if secrets.held_out(r, rule)}
        assert held and not held & set(trained)
    every = {(c.before, c.body, c.after) for r in found.collect() for c in r._candidates if c.label}
    held = [c for c in every if secrets.held_out(c, m["rules"][True])]
    assert len(held) > 40 and (secrets._logits(m, held) >= m["threshold"]).mean() >= 0.99


def test_every_label_is_split():
    for n in (1, 2, 5, 40):
        rows = [(f"b{i} ", f"text{i % n}0123456789", "") for i in range(40)]
        rule = secrets.split_rule(rows)
        assert len({secrets.held_out(r, rule) for r in rows}) == 2


def test_secrets_on_rows(edges, empty):
    rows = secrets.find(edges).collect()
    assert len(rows) == 10
    assert [r.spans for r in rows if r.doc_id == 8] == ["assign:2:28,access:30:50,hex:51:83"]
    assert [r.spans for r in rows if r.doc_id in (1, 2, 3)] == [""] * 3
    red = secrets.redact(edges)
    assert red.columns == edges.columns
    assert [r.text for r in red.collect() if r.doc_id == 8] == ['x [secret]" [secret] [secret]']
    assert secrets.find(empty).collect() == [] and secrets.redact(empty).collect() == []


def test_language_of_held_out_documents(spark, docs, sf):
    from lakekit.llm import queries

    rows = queries.QUERIES["op7_language_id"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(docs[r.doc_id].lang == r.lang_pred for r in held) / len(held) > 0.95


def test_language_against_plain_bayes(spark):
    """Counts and probabilities worked out again in plain Python."""
    rows = [(1, "abab", "x"), (2, "bcbc cb", "y"), (3, "ab", "x"), (4, None, "x"), (5, "abc", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.train(df, bits=10)
    counts = {"x": np.ones(1024), "y": np.ones(1024)}
    for _, t, lang in rows:
        if t and lang:
            for ids in langid.buckets_of(t, 3, 10):
                np.add.at(counts[lang], ids, 1)
    assert m["langs"] == ["x", "y"]
    total = np.log(np.array([2 / 3, 1 / 3]))
    for ids in langid.buckets_of("ab cb", 3, 10):
        total += [np.log(counts[x] / counts[x].sum())[ids].sum() for x in "xy"]
    got = langid.predict(spark.createDataFrame([(9, "ab cb")], "doc_id long, text string"), m).first()
    assert got.lang_pred == "xy"[int(np.argmax(total))]
    assert abs(got.score - 1 / np.exp(total - total.max()).sum()) < 1e-4


def test_language_on_rows(edges, empty):
    m = langid.train(edges)
    rows = langid.predict(edges, m, keep=("doc_id", "lang")).collect()
    assert len(rows) == 10 and all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert langid.predict(empty, m).collect() == []
    nothing = langid.predict(edges, langid.train(empty)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_long_text_is_worked_through_in_pieces():
    text = "abcd" * 700_000
    n = sum(len(x) for x in langid.buckets_of(text, 3, 16))
    assert n == 3 * (len(text) + 2) - 3


def test_quality_counts(spark, words):
    texts = ["a b c d e f a b c d e", "x\nx\n\n \ny\nx", "# $ 5%", "", None, "one two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in quality.counts(df, keep=["doc_id"]).collect()}
    assert [got[i].n_words for i in range(6)] == [11, 4, 3, 0, 0, 2]
    assert [got[i].n_dup_lines for i in range(6)] == [0, 2, 0, 0, 0, 0]
    assert [got[i].n_symbols for i in range(3)] == [0, 0, 3]
    assert got[0].n_repeat_words == 10 and got[1].n_repeat_words == 0
    assert got[2].word_chars == 4


def test_quality_on_rows(edges, empty):
    rows = quality.judge(edges).collect()
    assert len(rows) == 10
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 4, 7))
    assert all(r.kept for r in rows if r.doc_id == 5)
    kept = quality.filter_documents(edges)
    assert kept.columns == edges.columns and kept.where("doc_id = 5").count() == 2
    assert quality.judge(empty).collect() == [] and quality.filter_documents(empty).collect() == []


def test_every_quality_rule_decides(spark):
    word = lambda i, n=5: "".join(chr(97 + (i * 7919 // 26**k) % 26) for k in range(n))
    plain = [(i, "\n".join(" ".join(word(i * 50 + 5 * r + k) for k in range(5)) for r in range(8))) for i in range(60)]
    passage = " ".join(word(9000 + k) for k in range(8))
    odd = {
        "symbols": " ".join(word(k) + "#" * (k % 4 == 0) for k in range(40)),
        "length": " ".join(word(k, 12) for k in range(40)),
        "short": " ".join("abcdefghijklmnopqrstuvwxyz0123456789"),
        "dup_lines": "\n".join(f"again\n{word(k)}" for k in range(10)),
        "repeats": " ".join([passage, *[word(k) for k in range(84)], passage]),
    }
    rows = plain + [(100 + i, t) for i, t in enumerate(odd.values())]
    df = spark.createDataFrame([(i, t, "x", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    assert set(odd) == set(quality.RULES)
    assert [got[100 + i].failed for i in range(len(odd))] == [[r] for r in odd]
    assert not any(r.base_failed for r in got.values()) and all(got[i].kept for i, _ in plain)


def test_quality_thresholds_follow_the_group(spark):
    """Symbols are common in one source and junk in another."""
    plain = [(i, "plain words in a row without any signs at all here " * 2 + str(i), "en", "prose") for i in range(80)]
    code = [(100 + i, "int * p = & x ; a < b & c > d ; # " * 2 + f"define {i}", "en", "code") for i in range(80)]
    junk = [(300, "### $$$ %%% &&& *** junk " * 3, "en", "prose")]
    df = spark.createDataFrame(plain + code + junk, "doc_id long, text string, lang string, source string")
    rows = {r.doc_id: r for r in quality.judge(df, most_repeats=100).collect()}
    assert all(rows[i].kept for i in range(80)) and all(rows[100 + i].kept for i in range(80))
    assert rows[300].failed == ["symbols"] and not rows[300].kept


@pytest.fixture(scope="module")
def keyed_texts():
    """(id, text, planted span or None): labelled secrets to learn from, and pairs whose second half no pattern knows."""
    r = random.Random(12)
    solid = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    caps = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    plain = lambda: "-".join(r.choice(["north", "river", "table", "window", "garden"]) for _ in range(3)) + f"-{r.randrange(10, 99)}"
    rows = [(i, f"see {r.choice(['token', 'api_key', 'secret'])}={solid(r.randrange(24, 44))} here", None) for i in range(300)]
    rows += [(300 + i, f"see {plain()} and {plain()} there", None) for i in range(400)]
    for i in range(60):
        first, second = "AKIA" + caps(16), solid(40)
        rows.append((1000 + i, f"key {first}/{second} end", (4 + len(first), 4 + len(first) + 1 + len(second))))
    return rows


def test_the_rest_of_a_partly_covered_run(spark, keyed_texts):
    """The secret half of a pair joined by a slash is found and redacted; harmless runs and the labels stay as they were."""
    df = spark.createDataFrame([r[:2] for r in keyed_texts], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.find(df).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    halves = [(i, t, p) for i, t, p in keyed_texts if p]
    found = [f"cnn:{p[0]}:{p[1]}" in spans[i] for i, _, p in halves]
    assert np.mean(found) >= 0.9
    assert np.mean([t[p[0] + 1 : p[1]] not in clean[i] for i, t, p in halves]) >= 0.9
    wrong = [spans[i] for i, t, p in keyed_texts if 300 <= i < 1000 and spans[i]]
    assert len(wrong) <= 0.02 * 400 + 2
    c = secrets.candidates(halves[0][1], secrets.base_spans(halves[0][1]))
    assert [x[2] for x in c] == [True, None] and c[1][4].startswith("/")


def test_base_spans_against_a_scan_by_hand(docs):
    """The fixed patterns read character by character, without regular expressions."""
    solid = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    caps, low_hex = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), set("0123456789abcdef")
    run = lambda t, i, of: next((j for j in range(i, len(t)) if t[j] not in of), len(t))

    def assign(t, i):
        low = t[i : i + 8].lower()
        for w in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low.startswith(w) and t[i : i + len(w)].isascii():
                j = i + len(w)
                j += t[j : j + 1] in ('"', "'") and t[j : j + 1] != ""
                j = run(t, j, {" "})
                if t[j : j + 1] not in (":", "=") or j >= len(t):
                    return None
                j = run(t, j + 1, {" "})
                j += t[j : j + 1] in ('"', "'") and t[j : j + 1] != ""
                end = run(t, j, solid)
                return (end, end - j >= 6) if end > j else None
        return None

    def by_hand(t):
        out = []
        i = 0
        while i < len(t):
            m = assign(t, i)
            if m:
                out += [(0, i, m[0])] if m[1] else []
                i = m[0]
            else:
                i += 1
        for kind, head, of, least in ((1, "AKIA", caps, 20), (2, "", low_hex, 24)):
            i = 0
            while i < len(t):
                if t.startswith(head, i) and (end := run(t, i + len(head), of)) > i + len(head):
                    out += [(kind, i, end)] if end - i >= least else []
                    i = end
                else:
                    i += 1
        return out

    texts = [r.text or "" for r in docs.values()] + ['api_key: "abcdef"', "apiKEY=abc", "PASSWORD='x=y_z.1", "AKIAAKIA" + "A" * 14, "token  :  " + "f" * 24, "secret= ", "token==abcdefg"]
    for t in texts:
        assert sorted(secrets.base_spans(t)) == sorted(by_hand(t)), t[:80]


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    """Two thirds of the budget is about two thirds of the rows also where ids are NULL: they are no single block."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" a b c")).alias("text"), F.lit("en").alias("lang"), F.lit("src1").alias("source"))
    got = mixing.choose(df, 0.5, "'d'", epochs=1)
    n = got.where("c0 is null").count()
    assert got.count() == 1500 and 400 < n < 600
