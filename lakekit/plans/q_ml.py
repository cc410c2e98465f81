"""Features, preprocessing, classifiers, evaluation and scoring.

The features of an order item stand in for the chemistry of a product; the label is "returned".
"""

from __future__ import annotations

from ..functions import udfs as D
from ..operators import attribution as AT, cells as TR, ml as M, nets as NN, tuning as TU
from ..session import materialize
from .registry import F, W, load, query

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _base(spark, d):
    """One row per order (unique key) with numeric columns, a category and a label."""
    o = load(spark, d, "orders")
    return o.select("o_orderkey", "o_totalprice", F.month("o_orderdate").alias("month"), F.dayofweek("o_orderdate").alias("dow"),
                    F.col("o_orderpriority").alias("kind"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))


ITEM_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def _items(spark, d, key=()):
    """Order items with a label that depends on the features, so that models have something to learn."""
    li = load(spark, d, "lineitem")
    return li.select(*key, *NUM, F.col("l_linestatus").alias("kind"), (F.col("l_extendedprice") / F.col("l_quantity") > 2000).cast("int").alias("label"))


@query("m01_feature_table", """
select p_partkey, round(1e6 / pow(10, p_size / 10.0), 4) as h_concentration, round(ln(p_size / p_retailprice), 6) as acidity_ratio from part
""")
def m01(spark, d):
    p = load(spark, d, "part").withColumn("ph", F.col("p_size") / 10.0)
    f = M.feature_table(M.derive_features(p, "ph", "p_size", "p_retailprice"), "p_partkey")
    return f.select("p_partkey", F.round(F.col("h_concentration") * 1e6, 4).alias("h_concentration"), F.round("acidity_ratio", 6).alias("acidity_ratio"))


@query("m02_split", """
select o_orderkey, case when h <= 'b3333332' then 'train' when h <= 'e6666665' then 'valid' else 'test' end as split
from (select o_orderkey, substr(md5('42|' || o_orderkey::varchar), 1, 8) as h from orders)
""")
def m02(spark, d):
    return M.split(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("m03_training_set", """
select l_linenumber, l_quantity, round(1e6 / pow(10, p_size / 10.0), 4) as h_concentration, case when l_returnflag = 'R' then 1 else 0 end as quality
from lineitem left join part on l_partkey = p_partkey
""")
def m03(spark, d):
    p, li = load(spark, d, "part", "lineitem")
    feats = p.select("p_partkey", F.round(M.h_concentration(F.col("p_size") / 10.0) * 1e6, 4).alias("h_concentration"))
    base = li.select(F.col("l_partkey").alias("p_partkey"), "l_linenumber", "l_quantity", F.col("l_returnflag").alias("quality"))
    return M.binarize(M.training_set(base, feats, "p_partkey", ["h_concentration"], "quality", exclude=["p_partkey"]), "quality", "R")


@query("m05_numeric_prep", """
with x as (select l_orderkey, l_linenumber, l_partkey, case when l_returnflag <> 'N' then l_quantity end as q from lineitem),
 f as (select l_orderkey, l_linenumber, l_partkey, coalesce(q, avg(q) over ()) as q from x)
select l_orderkey, l_linenumber, l_partkey, round((q - avg(q) over ()) / stddev_pop(q) over (), 5) + 0.0 as z from f
""")
def m05(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr("case when l_returnflag <> 'N' then cast(l_quantity as string) end").alias("q"))
    stats = M.numeric_stats(li, ["q"])
    return li.select("l_orderkey", "l_linenumber", "l_partkey", (F.round(M.z_score("q", stats), 5) + 0.0).alias("z"))


@query("m06_one_hot", """
select o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), '') as kind, case when o_orderstatus = 'P' then 0.0 else 1.0 end::double as ones from orders
""")
def m06(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.expr("nullif(o_orderpriority, '5-LOW')").alias("kind"))
    prep = M.Preprocessor(exclude=["o_orderkey", "o_orderstatus"]).fit(o)
    # open orders arrive with a category the encoder has not seen
    scored = o.withColumn("kind", F.when(F.col("o_orderstatus") == "P", "unseen").otherwise(F.col("kind")))
    x = prep.transform(scored).withColumn("ones", F.aggregate(M.vector_to_array("features"), F.lit(0.0), lambda a, b: a + b))
    return x.join(o.select("o_orderkey", F.coalesce("kind", F.lit("")).alias("k")), "o_orderkey").select("o_orderkey", F.col("k").alias("kind"), "ones")


@query("m06_many_categories", """
with k as (select cast(l_partkey as varchar) as part, count(*) as n from lineitem group by 1), h as (select part from k order by n desc, part limit 100)
select l_returnflag, count(*) as n, count(h.part) as in_head, cast(count(*) as double) as ones
from lineitem l left join h on cast(l.l_partkey as varchar) = h.part group by 1
""")
def m06_many(spark, d):
    li = load(spark, d, "lineitem").select("l_returnflag", F.col("l_partkey").cast("string").alias("part"))
    x = M.Preprocessor(exclude=["l_returnflag"], most=100, tail=16).fit(li).transform(li).withColumn("v", M.vector_to_array("features"))
    ones = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
    return x.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if(ones(F.slice("v", 1, 100)) == 1.0).alias("in_head"), F.sum(ones("v")).alias("ones"))


@query("m07_column_transformer", """
select o_orderkey, round((o_totalprice - avg(o_totalprice) over ()) / stddev_pop(o_totalprice) over (), 5) + 0.0 as z, cast(8 as integer) as width, label from
 (select o_orderkey, o_totalprice, case when o_orderstatus = 'F' then 1 else 0 end as label from orders)
""")
def m07(spark, d):
    base = _base(spark, d)
    x = M.Preprocessor("label", ["o_orderkey"]).fit(base).transform(base)
    a = M.vector_to_array("features")
    return x.select("o_orderkey", (F.round(a[0], 5) + 0.0).alias("z"), F.size(a).alias("width"), "label")


def _prepared(spark, d):
    """(preprocessing, prepared training rows, prepared validation rows, validation rows)"""
    items = M.split(_items(spark, d, ITEM_KEY), ITEM_KEY, {"train": 0.7, "valid": 0.3})
    train, valid = [items.where(F.col("split") == s).drop("split", *ITEM_KEY) for s in ("train", "valid")]
    prep = M.Preprocessor("label").fit(train)
    tr = M.keep_for_training(prep.transform(train).select("features", "label"))
    return prep, tr, prep.transform(valid), valid


def _fitted(spark, d, make):
    prep, tr, valid, rows = _prepared(spark, d)
    return make(tr).fit(tr), prep, tr, valid, rows


#: The validation rows and their positives by SQL; the rest must hold of any model that has learned.
VALID_SQL = """
with v as (
  select case when l_extendedprice / l_quantity > 2000 then 1 else 0 end as y from lineitem
  where substr(md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey), 1, 8) > 'b3333333')
"""
REPORT_SQL = VALID_SQL + "select count(*) as n, sum(y)::bigint as positives, true as counts_agree, true as learned from v"


def _report(spark, d, make):
    """The rows are scored once, into counts per (label, prediction, probability); everything else comes from these."""
    _, tr, valid, _ = _prepared(spark, d)
    trainer = TR.Trainer(tr)
    model = trainer.fit(make(tr))
    per = materialize(M.score(model, valid).groupBy("label", "prediction", "probability_1").agg(F.count(F.lit(1)).alias("w")))
    trainer.unpersist()
    tr.unpersist()
    auc = M.auc_frame(per, "label", "probability_1", weight="w").first()[0]
    cell = lambda y, p: F.coalesce(F.sum(F.when((F.col("label") == y) & (F.col("prediction") == p), F.col("w"))), F.lit(0))
    tp, fp, fn, tn = cell(1, 1), cell(0, 1), cell(1, 0), cell(0, 0)
    one = per.agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("label")).alias("positives"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    agree = (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn") == F.col("n")) & (F.col("tp") + F.col("fn") == F.col("positives"))
    return one.select("n", "positives", agree.alias("counts_agree"), F.lit(auc > 0.9).alias("learned"))


@query("m08_random_forest", REPORT_SQL)
def m08(spark, d):
    return _report(spark, d, lambda tr: M.random_forest())


@query("m09_boosted_trees", REPORT_SQL)
def m09(spark, d):
    return _report(spark, d, lambda tr: M.boosted_trees())


@query("m10_neural_net", REPORT_SQL)
def m10(spark, d):
    return _report(spark, d, lambda tr: M.neural_net(tr.first().features.size))


@query("m11_parameter_search", "select i::integer as trial, true as learned, true as has_parameters from range(5) t(i)")
def m11(spark, d):
    _, tr, _, _ = _prepared(spark, d)
    trials = M.search(tr, trials=5, parallelism=10)[1]
    tr.unpersist()
    return trials.select("trial", (F.col("auc") > 0.8).alias("learned"), F.col("params").contains("maxDepth").alias("has_parameters"))


@query("m12_exact_auc", """
with d as (select case when event_type = 'purchase' then 1 else 0 end as y, value as p from events),
 r as (select y, avg(rk) over (partition by p) as ar from (select y, p, cast(row_number() over (order by p) as double) as rk from d))
select round((sum(case when y = 1 then ar else 0 end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 6) as auc from r
""")
def m12(spark, d):
    e = load(spark, d, "events").select((F.col("event_type") == "purchase").cast("int").alias("y"), "value")
    return M.auc_frame(e, "y", "value").select(F.round("auc", 6).alias("auc"))


@query("m12_confusion", "select case when o_totalprice > 250000 then 1 else 0 end as label, case when o_orderstatus = 'F' then 1 else 0 end as prediction, count(*) as n from orders group by 1, 2")
def m12b(spark, d):
    o = load(spark, d, "orders").select((F.col("o_totalprice") > 250000).cast("int").alias("label"), (F.col("o_orderstatus") == "F").cast("int").alias("prediction"))
    return M.confusion(o, "label")


@query("m12_classification_metrics", """
select tp, fp, fn, tn, round((tp + tn)::double / (tp + fp + fn + tn), 6) as accuracy, round(tp::double / (tp + fp), 6) as precision, round(tp::double / (tp + fn), 6) as recall from (
 select count(*) filter (y and p) as tp, count(*) filter (not y and p) as fp, count(*) filter (y and not p) as fn, count(*) filter (not y and not p) as tn
 from (select o_totalprice > 250000 as y, o_orderstatus = 'F' as p from orders))
""")
def m12c(spark, d):
    o = load(spark, d, "orders").select((F.col("o_totalprice") > 250000).cast("int").alias("label"), (F.col("o_orderstatus") == "F").cast("int").alias("prediction"))
    m = M.classification_metrics(o, "label")
    return m.select("tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ["accuracy", "precision", "recall"]])


@query("m15_batch_inference", "select count(*) as n, true as same, true as in_range from lineitem")
def m15(spark, d):
    model, prep, tr, _, _ = _fitted(spark, d, lambda tr: M.logistic())
    tr.unpersist()
    x = prep.transform(_items(spark, d))
    s = M.score(model, x)
    f = D.model_function(D.linear_predictor(model.coefficients, model.intercept), [f"f{i}" for i in range(model.numFeatures)])
    a = M.vector_to_array("features")
    s = s.withColumn("p2", f(*[a[i] for i in range(model.numFeatures)]))
    return s.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.abs(F.col("p2") - F.col("probability_1")) < 1e-9).alias("same"), F.bool_and(F.col("p2").between(0, 1)).alias("in_range"))


@query("m16_partial_dependence", VALID_SQL + """
select grid, count(*) as n, true as is_probability, true as rises from v, (select unnest([1000.0::double, 10000.0, 30000.0, 60000.0, 90000.0]) as grid) group by grid
""")
def m16(spark, d):
    model, prep, tr, _, valid = _fitted(spark, d, lambda tr: M.random_forest())
    tr.unpersist()
    got = M.partial_dependence(model, prep, valid, "l_extendedprice", [1000.0, 10000.0, 30000.0, 60000.0, 90000.0])
    before = F.lag("mean_probability").over(W.orderBy("grid"))  # one row per grid value
    return got.select("grid", "n", F.col("mean_probability").between(0, 1).alias("is_probability"), F.coalesce(F.col("mean_probability") >= before - 0.02, F.lit(True)).alias("rises"))


@query("m17_model_comparison", "select unnest(['boosted', 'forest', 'net']) as model, 'fitted' as status, true as learned")
def m17(spark, d):
    _, tr, valid, _ = _prepared(spark, d)
    ranked = M.compare(tr, valid, {"forest": M.random_forest(), "boosted": M.boosted_trees(), "net": M.neural_net(tr.first().features.size)})
    tr.unpersist()
    return ranked.select("model", "status", (F.col("auc") > 0.9).alias("learned"))


@query("m08_model_metrics")
def m08_metrics(spark, d):
    """Forest, boosted trees and net on one split: the whole confusion table, the rates made from it and the exact AUC."""
    _, tr, valid, _ = _prepared(spark, d)
    out, trainer = None, TR.Trainer(tr)
    for name, est in {"boosted": M.boosted_trees(), "forest": M.random_forest(), "net": M.neural_net(tr.first().features.size)}.items():
        scored = materialize(M.score_counted(trainer, trainer.fit(est), valid))
        auc = M.auc_frame(scored, "label", "probability_1", weight="w").first()[0]
        one = M.classification_metrics(scored, "label", weight="w").select(F.lit(name).alias("model"), "*", F.lit(auc).alias("auc"))
        out = one if out is None else out.unionByName(one)
    trainer.unpersist()
    tr.unpersist()
    return out


@query("m11_parzen_search")
def m11_parzen(spark, d):
    """Every trial with its AUC and parameters: eight drawn at random, eight proposed from those that ended."""
    _, tr, valid, _ = _prepared(spark, d)
    trials = TU.search_boosted(tr, valid.select("features", "label"), trials=16, parallelism=4)[1]
    tr.unpersist()
    return trials


@query("m16_dependence_values")
def m16_values(spark, d):
    model, prep, tr, _, valid = _fitted(spark, d, lambda tr: M.random_forest(trees=10, depth=6))
    tr.unpersist()
    return M.partial_dependence(model, prep, valid, "l_extendedprice", [1000.0, 10000.0, 30000.0, 60000.0, 90000.0])


@query("m16_attribution")
def m16_attribution(spark, d):
    """Mean Shapley values of every feature over all validation rows; the worst gap between base plus values and the prediction."""
    model, prep, tr, valid, rows = _fitted(spark, d, lambda tr: M.random_forest(trees=10, depth=6))
    tr.unpersist()
    index = sorted((a["idx"], a["name"]) for kind in valid.schema["features"].metadata["ml_attr"]["attrs"].values() for a in kind)
    scored = M.score(model, valid).select("features", "probability_1")
    values = materialize(AT.attributions(model, scored, keep=["probability_1"]))
    gap = values.agg(F.max(F.abs(F.col("base") + F.aggregate("attribution", F.lit(0.0), lambda a, x: a + x) - F.col("probability_1")))).first()[0]
    return AT.by_feature(values, [n for _, n in index]).withColumn("largest_gap", F.lit(gap))


@query("m17_halving")
def m17_halving(spark, d):
    """Ranking and AUC of models that were given more rows round by round."""
    items = M.split(_items(spark, d, ITEM_KEY), ITEM_KEY, {"train": 0.7, "valid": 0.3})
    train, valid = [items.where(F.col("split") == s).drop("split") for s in ("train", "valid")]
    prep = M.Preprocessor("label", exclude=ITEM_KEY).fit(train)
    tr = M.keep_for_training(prep.transform(train).select("features", "label", *ITEM_KEY))
    ranked = TU.halving(tr, prep.transform(valid), {"forest": M.random_forest(trees=10, depth=6), "boosted": M.boosted_trees(iterations=5), "logistic": M.logistic()}, ITEM_KEY)
    tr.unpersist()
    return ranked


@query("m10_minibatch_net")
def m10_minibatch(spark, d):
    """The net of 64 and 64 units after two epochs of mini-batches of 128: loss of both epochs, confusion table, rates and exact AUC."""
    _, tr, valid, _ = _prepared(spark, d)
    model = NN.NetClassifier().fit(tr)
    tr.unpersist()
    scored = materialize(M.score(model, valid).select("label", "prediction", "probability_1"))
    loss = lambda e: F.sum(F.when(F.col("epoch") == e, F.col("loss") * F.col("n"))) / F.sum(F.when(F.col("epoch") == e, F.col("n")))
    h = model.history(spark).agg(loss(0).alias("first_loss"), loss(1).alias("last_loss")).first()
    return M.classification_metrics(scored, "label").select("*", F.lit(M.auc(scored, "label")).alias("auc"), F.lit(h.first_loss).alias("first_loss"), F.lit(h.last_loss).alias("last_loss"))
