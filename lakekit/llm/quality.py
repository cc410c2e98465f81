"""Quality rules with thresholds that follow the data.

Every document gets a few whole numbers (symbols per word, length of words, words to a thousand characters, share of repeated
lines and of repeated words). Their distribution is kept per language and source in a mergeable sketch: the count of every bin, where a bin is a
value with its five leading bits, so any quantile is known to 1/16 and sketches are merged by adding counts. A document fails
a rule when its value lies above the fence ``q75 + spread * max(q75 - q25, least)`` of its own language and source. The least
widths leave the fences of uniform groups below the fixed floor of ``judge``, so every rule can decide; very short words are many
words to a thousand characters, so ``short`` is the lower fence of their length. Groups of
fewer than ``enough`` documents use the sketch of their language, and where that is small as well the one of all documents.

DataFrame functions only. Documents are read once; what is written in between are the numbers, or rows that carry the
columns named in ``keep``. Sketches are aggregated on the map side, so a source with a third of all rows costs a few rows per task.

NULL text counts as no words and fails; NULL language or source is a group of its own; repeated rows are judged alike, each
for itself; of extra columns only those in ``keep`` are read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WHITE, stored, without, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: rule: (its value from the counts, least width between the quartiles, in the unit of the value)
RULES = {
    "symbols": ("div(1000 * n_symbols, n_words)", 40),
    "length": ("div(100 * word_chars, n_words)", 120),
    "short": ("div(1000 * n_words, word_chars)", 80),
    "dup_lines": ("div(1000 * n_dup_lines, n_lines)", 100),
    "repeats": ("div(1000 * n_repeat_words, n_words)", 50),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def counts(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the counts of ``COUNTS`` for every document; a column of ``keep`` with the name of a count is replaced by it."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = without(docs.select(*keep), COUNTS).columns
    df = docs.select(*kept, t.alias("_t"))
    solid = lambda c: F.translate(c, WHITE, "")
    df = df.select(
        *kept,
        words("_t").alias("_w"),
        F.length(solid(F.col("_t"))).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n", -1), lambda x: solid(x) != "").alias("_l"),
    )
    n = F.size("_w")
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)])))
    df = df.select(
        *kept, n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), grams.alias("_g"),
    )
    # most documents repeat no window: the sort is for the others
    again = F.coalesce(F.size(F.array_distinct("_g")) < F.size("_g"), F.lit(False))
    df = df.select("*", F.when(again, F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s")).drop("_g")
    equal = lambda x, i, j: F.coalesce(F.get("_s", j)["h"] == x["h"], F.lit(False))
    marked = F.transform("_s", lambda x, i: F.when(((i > 0) & equal(x, i, i - 1)) | equal(x, i, i + 1), x["i"]))
    df = df.select("*", F.sort_array(F.array_compact(marked)).alias("_p")).drop("_s")
    steps = F.aggregate(F.transform("_p", lambda p, i: F.least(F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda a, x: a + x)
    return df.select(*kept, *COUNTS[:4], F.coalesce(steps, F.lit(0)).cast("long").alias("n_repeat_words"), "n_lines")


def values(counted: DataFrame) -> list[Column]:
    return [F.when((F.col("n_words") > 0) & (F.col("n_lines") > 0), F.expr(e)).cast("long").alias(f"v_{r}") for r, (e, _) in RULES.items()]


def bin_of(v: Column) -> Column:
    """The value with its five leading bits."""
    s = F.greatest(F.length(F.bin(v)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, s), s)


def sketch(valued: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, rule, bin, n: the mergeable sketch of every group and rule."""
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), bin_of(F.col(f"v_{r}")).alias("bin")) for r in RULES]))
    return valued.where(F.col("v_symbols").isNotNull()).select(*by, pairs.alias("_x")).groupBy(*by, "_x.rule", "_x.bin").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: Sequence[str], qs: dict[str, float]) -> DataFrame:
    """by, rule, total and the bin at every quantile: the first whose cumulative count reaches ceil(q * total)."""
    w = W.partitionBy(*by, "rule")
    s = sketches.select("*", F.sum("n").over(w).alias("total"), F.sum("n").over(w.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)).alias("upto"))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("total")), F.col("bin"))).alias(name) for name, q in qs.items()]
    return s.groupBy(*by, "rule").agg(F.first("total").alias("total"), *at)


def thresholds(valued: DataFrame, lang: str = "lang", source: str = "source", spread: int = 3, enough: int = 50) -> DataFrame:
    """One row per language and source: its fence for every rule (``f_<rule>``)."""
    fine = stored(sketch(valued, [lang, source]), "sketch")
    qs = {"q1": 0.25, "q3": 0.75}
    own = quantiles(fine, [lang, source], qs)
    tongue = quantiles(merge(fine, [lang]), [lang], qs).select(F.col(lang).alias("_tongue"), F.col("rule").alias("_rule"), *[F.col(c).alias(f"l_{c}") for c in ("total", "q1", "q3")])
    every = quantiles(merge(fine, []), [], qs).select(F.col("rule").alias("_every"), *[F.col(c).alias(f"a_{c}") for c in ("q1", "q3")])
    j = own.join(tongue, F.col(lang).eqNullSafe(F.col("_tongue")) & (F.col("rule") == F.col("_rule"))).join(F.broadcast(every), F.col("rule") == F.col("_every"))  # one row per rule
    pick = lambda q: F.when(F.col("total") >= enough, F.col(q)).when(F.col("l_total") >= enough, F.col(f"l_{q}")).otherwise(F.col(f"a_{q}"))
    least = F.create_map(*[F.lit(x) for r, (_, w) in RULES.items() for x in (r, w)])[F.col("rule")]
    fence = pick("q3") + spread * F.greatest(pick("q3") - pick("q1"), least)
    return j.groupBy(lang, source).agg(*[F.max(F.when(F.col("rule") == r, fence)).alias(f"f_{r}") for r in RULES])


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: Sequence[str] = ("doc_id",), least_words: int = 10, most_repeats: int = 20, spread: int = 3, enough: int = 50) -> DataFrame:
    """``keep``, the counts, base_failed (fixed floor: too few words or too many repeats), kept, and the rules that failed."""
    made = [*COUNTS, "base_failed", "kept", "failed", "_lang", "_source", *[f"v_{r}" for r in RULES], *[f"f_{r}" for r in RULES]]
    cols = without(docs.select(*keep), made).columns
    with_groups = docs.select(*cols, F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.col(text).alias("_text"))
    counted = counts(with_groups, "_text", [*cols, "_lang", "_source"])
    valued = stored(counted.select("*", *values(counted)), "quality")
    fences = stored(thresholds(valued, "_lang", "_source", spread, enough).withColumnsRenamed({"_lang": "_fl", "_source": "_fs"}), "fences")
    few = fences.count() <= 1 << 16  # a few megabytes; then the rows, which may carry their text, stay where they are
    j = valued.join(F.broadcast(fences) if few else fences, F.col("_lang").eqNullSafe(F.col("_fl")) & F.col("_source").eqNullSafe(F.col("_fs")), "left")
    failed = F.array_compact(F.array(*[F.when(F.col(f"v_{r}") > F.col(f"f_{r}"), F.lit(r)) for r in RULES]))
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    return j.select(*cols, *COUNTS[:5], base.alias("base_failed"), (~base & (F.size(failed) == 0)).alias("kept"), failed.alias("failed"))


def filter_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents that are kept, with their columns; the rows are written once with their numbers, then filtered by a join
    with the fences, so that no text is shuffled while the fences are few."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = lambda c: f"c{names.index(c)}"
    out = judge(plain, at(params.pop("text", "text")), at(params.pop("lang", "lang")), at(params.pop("source", "source")), keep=plain.columns, **params)
    return out.where("kept").select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
