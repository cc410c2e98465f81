"""Mixing sources to target weights: a token budget handed down a tree of domain, language and source.

Every node has a weight among its siblings and a capacity: the tokens of its documents times the most epochs. From the root down, a
parent's budget is shared among its children in proportion to their weights; what a child cannot take goes to its siblings
in proportion again, until the budget is placed or all are full ("water filling"). As a parent never gets more than its
capacity, a shortage is met by siblings first and reaches the ancestors' other children only when the whole family is full. Shares are whole
tokens: the rounding loss of a family, fewer tokens than children, is not handed out.

A leaf reads its documents in epochs, each in an order of its own by md5 of (seed, epoch, doc_id). Its budget covers whole
epochs and, of the next one, the documents in order while they fit: the longest prefix whose tokens are within the budget.

DataFrame functions only. Token sums are map-side combined. The prefix is found without sorting a leaf in one task: the hash cuts
the leaf into ``SLICES`` slices, their sums give the slice that the budget ends in, and only the rows of that slice are put in order; a
slice of the largest leaf is 1/4096 of it. The tree (one row per leaf) stays a table; it is joined, by broadcast only if Spark finds it small.

A NULL text has no tokens, and a document without tokens is never chosen. NULL in domain, language or source is a value of
its own. Weights that are not given are 1, a weight of 0 or NULL closes a node. Documents with one id in one leaf share a place in the
order; ties are cut by the text. Extra columns pass through whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import stored, words

LEVELS = ("domain", "lang", "source")
SLICES = 4096


def same(a: Sequence[str], b: Sequence[str]) -> Column:
    cond = F.lit(True)
    for x, y in zip(a, b):
        cond = cond & F.col(x).eqNullSafe(F.col(y))
    return cond


def fill(children: DataFrame, parent: Sequence[str], budget: str) -> DataFrame:
    """Whole tokens for every child (columns _weight, _cap) from its parent's ``budget``: the level at which weights times
    level, capped, add up to the budget. Children are looked at in the order of cap / weight, as they fill up. A family is as
    many rows as it has children, never documents."""
    w = W.partitionBy(*parent)
    full = F.when(F.col("_weight") > 0, F.col("_cap").cast("double") / F.col("_weight")).otherwise(F.lit(0.0))
    cap = F.when(F.col("_weight") > 0, F.col("_cap")).otherwise(F.lit(0))
    df = children.withColumns({"_open": cap, "_full": full})
    up = w.orderBy("_full", *[c for c in children.columns if c.startswith("_key")]).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumns({"_capacity": F.sum("_open").over(w), "_weights": F.sum("_weight").over(w), "_before": F.coalesce(F.sum("_open").over(up), F.lit(0)), "_passed": F.coalesce(F.sum("_weight").over(up), F.lit(0.0))})
    # the level if this child and all after it were not full; the first child that can hold its own gives the highest such level
    level = (F.col(budget) - F.col("_before")) / (F.col("_weights") - F.col("_passed"))
    df = df.withColumn("_level", F.max(F.when((F.col("_weights") > F.col("_passed")) & (level <= F.col("_full")), level)).over(w))
    share = F.when(F.col(budget) >= F.col("_capacity"), F.col("_open")).otherwise(F.least(F.col("_open"), F.floor(F.col("_weight") * F.col("_level") + 1e-6)))
    return df.withColumn("_share", F.greatest(F.coalesce(share, F.lit(0)), F.lit(0)).cast("long")).drop("_open", "_full", "_capacity", "_weights", "_before", "_passed", "_level")


def budgets(leaves: DataFrame, total: int, weights: dict[str, str], epochs: int) -> DataFrame:
    """domain, lang, source, tokens, budget for every leaf of (domain, lang, source, tokens)."""
    leaves = leaves.withColumn("_leafcap", F.col("tokens") * epochs)
    got = None
    for i, level in enumerate(LEVELS):
        parent, own = list(LEVELS[:i]), list(LEVELS[: i + 1])
        family = leaves.groupBy(*own).agg(F.sum("_leafcap").alias("_cap")).withColumn("_weight", F.greatest(F.coalesce(F.expr(weights.get(level, "1")).cast("double"), F.lit(0.0)), F.lit(0.0)))
        family = family.withColumn("_key", F.coalesce(F.col(level).cast("string"), F.lit("")))
        if got is None:
            family = family.withColumn("_b", F.lit(total).cast("long"))
        else:
            up = got.toDF(*[f"_p{j}" for j in range(i)], "_b")
            family = family.join(up, same(parent, [f"_p{j}" for j in range(i)])).drop(*[f"_p{j}" for j in range(i)])
        got = fill(family, parent or [F.lit(0)], "_b").select(*own, F.col("_share").alias("_b"))
    out = got.toDF(*[f"_l{j}" for j in range(3)], "budget")
    return leaves.join(out, same(LEVELS, [f"_l{j}" for j in range(3)])).select(*LEVELS, "tokens", "budget")


def choose(docs: DataFrame, total: int | float, domain: str, lang: str = "lang", source: str = "source", text: str = "text", doc_id: str = "doc_id", weights: dict[str, str] | None = None, epochs: int = 4, seed: int = 1) -> DataFrame:
    """The chosen documents, their columns renamed c0, c1, ..., with _domain, _tokens and _copies (how often each is read, at least once).

    ``total`` tokens as a whole number, or as a share of all tokens if it is a float. ``domain`` is an expression over the documents;
    ``weights`` gives expressions over the level's own column for "domain", "lang" and "source".
    """
    names = docs.columns
    tokens = F.size(words(text)).cast("long")
    at = {n: f"c{i}" for i, n in enumerate(names)}
    tie = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))  # stands for an id that is NULL, so that such rows are drawn one by one
    tagged = docs.select(F.expr(domain).alias("_domain"), F.col(lang).alias("_lang"), F.col(source).alias("_source"), tokens.alias("_tokens"), F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), tie)).alias("_id"), tie.alias("_tie"), *[F.col(n).alias(at[n]) for n in names])
    light = stored(tagged.where("_tokens > 0").select("_domain", "_lang", "_source", "_tokens", "_id", "_tie"), "mixing")
    leaves = stored(light.groupBy(F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source")).agg(F.sum("_tokens").alias("tokens")), "leaves")
    if isinstance(total, float):
        total = int((leaves.agg(F.sum("tokens")).first()[0] or 0) * total)
    plan = budgets(leaves, total, weights or {}, epochs).select(F.col("domain").alias("_d"), F.col("lang").alias("_l"), F.col("source").alias("_s"), F.floor(F.col("budget") / F.col("tokens")).cast("long").alias("_epochs"), (F.col("budget") % F.col("tokens")).alias("_rest"))
    plan = stored(plan, "plan")
    leaf = ["_d", "_l", "_s"]
    joined = lambda df: df.join(plan, same(["_domain", "_lang", "_source"], leaf))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_epochs").cast("string"), F.col("_id")).cast("binary"))
    part = F.conv(F.substring("_key", 1, 3), 16, 10).cast("int")
    keyed = lambda df: joined(df).withColumn("_key", key).withColumn("_slice", part)
    sums = keyed(light).groupBy(*leaf, "_slice").agg(F.sum("_tokens").alias("_t"))
    upto = W.partitionBy(*leaf).orderBy("_slice").rowsBetween(W.unboundedPreceding, 0)
    ends = sums.withColumn("_upto", F.sum("_t").over(upto)).select(*[F.col(c).alias(f"{c}1") for c in leaf], F.col("_slice").alias("_at"), (F.col("_upto") - F.col("_t")).alias("_before"), "_upto")
    ends = stored(ends, "slices")
    cut = joined_ends(plan, ends, leaf)  # per leaf: the slice in which the rest ends, and the tokens before it
    inside = keyed(light).join(cut, same(leaf, ["_d2", "_l2", "_s2"]) & (F.col("_slice") == F.col("_cut")))
    order = W.partitionBy(*leaf).orderBy("_key", "_id", "_tie")
    edge = inside.withColumn("_sum", F.col("_from") + F.sum("_tokens").over(order)).groupBy(*leaf).agg(F.max(F.when(F.col("_sum") <= F.col("_rest"), F.struct("_key", "_id", "_tie"))).alias("_last"))
    edge = stored(cut.join(edge.toDF("_d3", "_l3", "_s3", "_last"), same(["_d2", "_l2", "_s2"], ["_d3", "_l3", "_s3"]), "left").select("_d2", "_l2", "_s2", "_cut", "_last"), "edges")
    out = keyed(tagged.where("_tokens > 0")).join(edge, same(leaf, ["_d2", "_l2", "_s2"]), "left")
    more = (F.col("_slice") < F.col("_cut")) | ((F.col("_slice") == F.col("_cut")) & F.coalesce(F.struct("_key", "_id", "_tie") <= F.col("_last"), F.lit(False)))
    copies = (F.col("_epochs") + F.coalesce(more, F.lit(False)).cast("long")).alias("_copies")
    return out.select(*at.values(), "_domain", "_tokens", copies).where("_copies > 0")


def joined_ends(plan: DataFrame, ends: DataFrame, leaf: list[str]) -> DataFrame:
    """The first slice whose running sum is above the rest of the leaf's budget; the rest is less than the leaf, so there is one."""
    j = plan.join(ends, same(leaf, [f"{c}1" for c in leaf])).where(F.col("_upto") > F.col("_rest"))
    return j.groupBy(*leaf).agg(F.min(F.struct("_at", "_before")).alias("_m")).select(*[F.col(c).alias(f"{c}2") for c in leaf], F.col("_m._at").alias("_cut"), F.col("_m._before").alias("_from"))


def mix(docs: DataFrame, total: int | float, domain: str, **params) -> DataFrame:
    """The documents of the mixture with their columns; one that is read in several epochs stands there as often."""
    names = docs.columns
    out = choose(docs, total, domain, **params)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
