"""The queries of this subpackage: every operator over its whole table, with DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from . import codes, ctw, fixity, jaccard, langid, mixing, phrases, pieces_codec, quality, secrets, token_trees, topk, trie
from .common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return deco


@query("op2_shingle_jaccard_groups")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"))


def own_edits(text: str = "text", doc_id: str = "doc_id"):
    """Three edits of every document, from its own id and length: a deletion, an insertion and a replacement."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    mark = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, 12)
    e = lambda start, deleted, inserted: F.struct(F.floor(start).cast("int").alias("start"), F.lit(deleted).alias("deleted"), inserted.alias("inserted"))
    return F.array(e(n / 3, 5, F.lit("")), e(n / 2, 0, F.concat(F.lit(" rev "), mark, F.lit("\n"))), e(3 * n / 4, 7, F.lit("'s  new  ")))


@query("op1_edited_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = token_trees.build(table(spark, sf_dir, "documents"))
    edited = token_trees.edit(trees.withColumn("edits", own_edits()))
    return edited.select("doc_id", "n_before", "n_tokens", F.length("text").cast("long").alias("n_chars"), "n_encoded_again")


PAGES_PER_FILE = 500


def archives(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Archive files of 500 pages each, and a replica with changed and lost records and one record too many in some files."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    part = F.floor(F.col("page_id") / PAGES_PER_FILE)
    records = pages.select(F.concat(F.lit("crawl-"), part.cast("string")).alias("file"), part.alias("part"), F.col("page_id"), F.col("page_id").cast("string").alias("record_id"), fixity.response(F.col("page_id"), F.col("url"), F.col("html")).alias("content"))
    w = W.partitionBy("file").orderBy("page_id").rowsBetween(W.unboundedPreceding, -1)
    records = records.withColumn("offset", F.coalesce(F.sum(F.octet_length("content")).over(w), F.lit(0)).cast("long"))
    n = F.col("page_id")
    kept = records.where(n % 89 != 5)
    damaged = kept.withColumn("content", F.when(n % 41 == 7, F.overlay("content", F.lit("#"), F.floor(F.length("content") / 2).cast("int"))).otherwise(F.col("content")))
    ends = records.where(F.col("part") % 7 == 3).groupBy("file").agg(F.max("offset").alias("o")).select("file", F.lit("extra").alias("record_id"), (F.col("o") + 100_000_000).alias("offset"), F.lit("late").alias("content"))
    columns = ["file", "offset", "record_id", "content"]
    return records.select(*columns), damaged.select(*columns).unionByName(ends.select(*columns))


@query("op3_merkle_fixity", r"""
with r as (
  select 'crawl-' || (page_id // 500)::varchar as file, page_id // 500 as part, page_id, page_id::varchar as record_id,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id::varchar || '>' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, ''))::varchar || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as content
  from pages),
a as (select *, coalesce(sum(strlen(content)) over (partition by file order by page_id rows between unbounded preceding and 1 preceding), 0)::bigint as o from r),
b as (
  select file, o, record_id, case when page_id % 41 = 7 then substr(content, 1, length(content) // 2 - 1) || '#' || substr(content, length(content) // 2 + 1) else content end as content from a where page_id % 89 <> 5
  union all select file, max(o) + 100000000, 'extra', 'late' from a where part % 7 = 3 group by file)
select coalesce(a.file, b.file) as file, coalesce(a.o, b.o) as "offset", coalesce(a.record_id, b.record_id) as record_id,
  case when a.o is null then 'extra' when b.o is null then 'missing' else 'changed' end as status,
  strlen(a.content) as length, sha256(a.content) as digest, strlen(b.content) as found_length, sha256(b.content) as found
from a full join b on a.file = b.file and a.o = b.o and a.record_id = b.record_id
where a.content is distinct from b.content
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.audit(*archives(spark, sf_dir))


#: A source's domain: its number modulo 4.
DOMAIN = "concat('d', cast(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4 as string))"
WEIGHTS = {"domain": "case domain when 'd0' then 4 when 'd1' then 3 when 'd2' then 2 else 1 end", "lang": "case lang when 'en' then 2 else 1 end"}


@query("op4_source_mixture", r"""
with t as (
  select doc_id, text, lang, source, 'd' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4)::varchar as domain, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as tokens from documents),
u as (select * from t where tokens > 0),
leaf as (select domain, lang, source, sum(tokens)::bigint as tokens, sum(tokens)::bigint * 3 as cap from u group by all),
total as (select floor(sum(tokens) * 0.6::double)::bigint as b from leaf),
d0 as (select domain, sum(cap) as cap, case domain when 'd0' then 4 when 'd1' then 3 when 'd2' then 2 else 1 end as w from leaf group by domain),
d1 as (select *, (select b from total) as b, cap / w::double as full_, sum(cap) over () as c, sum(w) over () as ws,
  coalesce(sum(cap) over (order by cap / w::double, coalesce(domain, '') rows between unbounded preceding and 1 preceding), 0) as before, coalesce(sum(w) over (order by cap / w::double, coalesce(domain, '') rows between unbounded preceding and 1 preceding), 0) as passed from d0),
d2 as (select *, max(case when (b - before) / (ws - passed)::double <= full_ then (b - before) / (ws - passed)::double end) over () as level from d1),
d as (select domain, (case when b >= c then cap else least(cap, floor(w * level + 1e-6)) end)::bigint as b from d2),
l0 as (select domain, lang, sum(cap) as cap, case lang when 'en' then 2 else 1 end as w from leaf group by all),
l1 as (select l0.*, d.b, cap / w::double as full_, sum(cap) over (partition by l0.domain) as c, sum(w) over (partition by l0.domain) as ws,
  coalesce(sum(cap) over (partition by l0.domain order by cap / w::double, coalesce(lang, '') rows between unbounded preceding and 1 preceding), 0) as before, coalesce(sum(w) over (partition by l0.domain order by cap / w::double, coalesce(lang, '') rows between unbounded preceding and 1 preceding), 0) as passed
  from l0 join d on l0.domain is not distinct from d.domain),
l2 as (select *, max(case when (b - before) / (ws - passed)::double <= full_ then (b - before) / (ws - passed)::double end) over (partition by domain) as level from l1),
l as (select domain, lang, (case when b >= c then cap else least(cap, floor(w * level + 1e-6)) end)::bigint as b from l2),
s1 as (select leaf.*, l.b, cap / 1::double as full_, sum(cap) over (partition by leaf.domain, leaf.lang) as c, count(*) over (partition by leaf.domain, leaf.lang) as ws,
  coalesce(sum(cap) over (partition by leaf.domain, leaf.lang order by cap, coalesce(source, '') rows between unbounded preceding and 1 preceding), 0) as before, row_number() over (partition by leaf.domain, leaf.lang order by cap, coalesce(source, '')) - 1 as passed
  from leaf join l on leaf.domain is not distinct from l.domain and leaf.lang is not distinct from l.lang),
s2 as (select *, max(case when (b - before) / (ws - passed)::double <= full_ then (b - before) / (ws - passed)::double end) over (partition by domain, lang) as level from s1),
plan as (select domain, lang, source, tokens, (case when b >= c then cap else least(cap, floor(level + 1e-6)) end)::bigint as budget from s2),
e as (select u.*, budget // plan.tokens as epochs, budget % plan.tokens as rest from u join plan on u.domain is not distinct from plan.domain and u.lang is not distinct from plan.lang and u.source is not distinct from plan.source),
o as (select *, sum(tokens) over (partition by domain, lang, source order by md5('1:' || epochs::varchar || ':' || coalesce(doc_id::varchar, '')), doc_id, md5(coalesce(text, '')) range between unbounded preceding and current row) as upto from e)
select doc_id, domain, tokens, (epochs + case when upto <= rest then 1 else 0 end)::bigint as copies from o where epochs + case when upto <= rest then 1 else 0 end > 0
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    got = mixing.choose(docs, 0.6, DOMAIN, weights=WEIGHTS, epochs=3)
    return got.select(F.col("c0").alias("doc_id"), F.col("_domain").alias("domain"), F.col("_tokens").alias("tokens"), F.col("_copies").alias("copies"))


@query("op5_exact_top_k", """
with v as (
  select row_number() over () as uid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)
select query_id, rank::int as rank, vec_id, score from (
  select q.vec_id as query_id, r.vec_id, list_inner_product(q.v, r.v)::bigint as score,
    row_number() over (partition by q.uid order by list_inner_product(q.v, r.v) desc, r.vec_id) as rank
  from v q join v r on q.uid <> r.uid where q.vec_id % 100 = 0)
where rank <= 10
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query("op6_context_tree")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold("doc_id", 5) == 0).alias("held_out"))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, keep=("doc_id", "held_out"))


@query("op9_quality_rules", r"""
with w as (
  select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
l as (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from w),
win as (select rid, i, ws[i:i + 4] as g from (select rid, ws, unnest(generate_series(1, len(ws) - 4)) as i from w)),
dup as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as k from win) where k > 1),
cov as (select rid, sum(least(5, coalesce(nxt - i, 5))) as n from (select rid, i, lead(i) over (partition by rid order by i) as nxt from dup) group by rid),
c as (
  select l.rid, doc_id, lang, source, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(ls) as n_lines
  from l left join cov using (rid)),
v as (
  select rid, lang, source, unnest(['symbols', 'length', 'short', 'dup_lines', 'repeats']) as rule,
    unnest([1000 * n_symbols // n_words, 100 * word_chars // n_words, 1000 * n_words // word_chars, 1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words]) as v
  from c where n_words > 0),
b as (select *, (v::bigint >> greatest(length(bin(v::bigint)) - 5, 0)) << greatest(length(bin(v::bigint)) - 5, 0) as b from v),
fine as (
  select lang, source, rule, any_value(total) as total, min(b) filter (where upto >= ceil(0.25 * total)) as q1, min(b) filter (where upto >= ceil(0.75 * total)) as q3
  from (select lang, source, rule, b, count(*) over (partition by lang, source, rule) as total, count(*) over (partition by lang, source, rule order by b) as upto from b) group by all),
tongue as (
  select lang, rule, any_value(total) as total, min(b) filter (where upto >= ceil(0.25 * total)) as q1, min(b) filter (where upto >= ceil(0.75 * total)) as q3
  from (select lang, rule, b, count(*) over (partition by lang, rule) as total, count(*) over (partition by lang, rule order by b) as upto from b) group by all),
every as (
  select rule, min(b) filter (where upto >= ceil(0.25 * total)) as q1, min(b) filter (where upto >= ceil(0.75 * total)) as q3
  from (select rule, b, count(*) over (partition by rule) as total, count(*) over (partition by rule order by b) as upto from b) group by all),
q as (
  select f.lang, f.source, f.rule, case when f.total >= 50 then f.q1 when t.total >= 50 then t.q1 else e.q1 end as q1,
    case when f.total >= 50 then f.q3 when t.total >= 50 then t.q3 else e.q3 end as q3
  from fine f join tongue t on f.lang is not distinct from t.lang and f.rule = t.rule join every e on f.rule = e.rule),
bad as (
  select distinct rid from v join q on v.lang is not distinct from q.lang and v.source is not distinct from q.source and v.rule = q.rule
  where v > q3 + 3 * greatest(q3 - q1, case q.rule when 'symbols' then 40 when 'length' then 120 when 'short' then 80 when 'dup_lines' then 100 else 50 end))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and bad.rid is null as kept
from c left join bad using (rid)
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("failed")


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


@query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_codec.encode(table(spark, sf_dir, "documents"))


@query("op11_repeated_phrases", r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select rid, i, array_to_string(ws[i:i + 34], ' ') as g from (select rid, ws, unnest(generate_series(1, len(ws) - 34)) as i from d)),
dup as (select rid, i from (select rid, i, count(*) over (partition by g) as k from win) where k > 1),
gone as (select distinct rid, unnest(generate_series(i, i + 34)) as p from dup),
word as (select rid, unnest(ws) as w, unnest(generate_series(1, len(ws))) as p from d),
kept as (select rid, count(*) as n, string_agg(w, ' ' order by p) as t from word anti join gone using (rid, p) group by rid)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (rid)
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = phrases.remove_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


CRC32 = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda u, v: xor(u >> 1, 3988292384::bigint * (u & 1)))), 4294967295::bigint)"


@query("op12_prefix_trie", f"""
with t as (
  select conv_id as c, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} as m,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
o as (select c, list(m order by pos) as ms, {CRC32} % 9 as h from t group by c),
r as (select o.c, list_concat(coalesce(b.ms[1:o.h], []), o.ms[o.h + 1:]) as ms from o left join o b on b.c = o.c - o.c % 5),
p as (select c, d, len(ms) as n, ms[1:d] as k from (select c, ms, unnest(range(0, len(ms) + 1)) as d from r)),
g as (
  select k, any_value(d) as depth, min(c) as rep, count(*) as n_convs, case when any_value(d) > 0 then strlen(any_value(k)[-1].x) else 0 end as bytes,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where d = n), '')) as ends_sha256
  from p group by k),
kids as (select k[1:depth - 1] as k, count(*) as n from g where depth > 0 group by all),
below as (
  select v.k[1:i] as k, sum((n_convs - 1) * bytes) as saved, count(*) filter (where kids.n is null) as leaves
  from (select *, unnest(range(0, depth + 1)) as i from g) v left join kids on v.k = kids.k group by all)
select g.rep as conv_id, g.depth::bigint as depth, up.rep as parent_conv_id, g.n_convs::bigint as n_convs, coalesce(kids.n, 0)::bigint as n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens, g.ends_sha256
from g join below on g.k = below.k left join kids on g.k = kids.k left join g up on g.depth > 0 and up.k = g.k[1:g.depth - 1] and up.depth = g.depth - 1
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.turns_of(table(spark, sf_dir, "conversations"))
    c = F.col("conv")
    return trie.prefix_trie(*trie.spliced(turns, c - c % 5, F.crc32(c.cast("string").cast("binary")) % 9, 8))


def code_rounds(rounds: int) -> str:
    """Rounds of assignment and update over x (rid, p, x), from the codebook k0 (p, e, x)."""
    nearest = lambda i: f"""
a{i} as materialized (
  select rid, p, x, best[1] as d, best[2]::bigint as e
  from (select rid, x.p, any_value(x.x) as x, min([list_inner_product(x.x, x.x) + list_inner_product(k.x, k.x) - 2 * list_inner_product(x.x, k.x), k.e::double]) as best from x join k{i} k on x.p = k.p group by rid, x.p)),"""
    update = lambda i: f"""
k{i + 1} as materialized (
  select k.p, k.e, coalesce(m.x, k.x) as x from k{i} k left join (
    select p, e, list(floor(s / n) order by j) as x from (
      select p, e, j, sum(c) as s, count(*) as n from (select p, e, unnest(x) as c, unnest(generate_series(1, len(x))) as j from a{i}) group by all) group by all) m
  on k.p = m.p and k.e = m.e),"""
    return "".join(nearest(i) + update(i) for i in range(rounds)) + nearest(rounds)


@query("op13_vector_codes", f"""
with v as (
  select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
x as materialized (select rid, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] as x from (select rid, v, unnest(range(0, 4)) as p from v)),
k0 as materialized (select p, e, x from x join (select rid, row_number() over (order by vec_id, v) - 1 as e from v qualify e < 256) using (rid)),
{code_rounds(4)}
coded as (select rid, string_agg(lower(printf('%02x', e)), '' order by p) as code, sum(d)::bigint as error from a4 group by rid),
books as (select sha256(string_agg(c::bigint::varchar, ',' order by p, e, j)) as s from (select p, e, unnest(x) as c, unnest(generate_series(1, len(x))) as j from k4))
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, (select s from books) as codebooks_sha256
from v join coded using (rid)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))
