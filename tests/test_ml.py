"""Preprocessing and models against values computed here."""

import math

import pytest
from pyspark.sql import functions as F

from lakekit.operators import ml as M


def test_numeric_prep_uses_the_population_deviation(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",), (None,), ("x",)], "a string")
    stats = M.numeric_stats(df, ["a"])
    assert stats["a"][0] == 2.0 and abs(stats["a"][1] - math.sqrt(2 / 5)) < 1e-12
    z = [r[0] for r in df.select(M.z_score("a", stats)).collect()]
    assert z[3] == z[4] == 0.0 and abs(z[0] + 1 / math.sqrt(2 / 5)) < 1e-12


def test_one_hot_and_unseen(spark):
    train = spark.createDataFrame([(1.0, "a", 1), (2.0, "b", 0), (3.0, None, 1), (4.0, "a", 0)], "x double, kind string, y int")
    prep = M.Preprocessor("y").fit(train)
    vec = lambda df: [list(r.features.toArray())[1:] for r in prep.transform(df).collect()]
    assert [sum(v) for v in vec(train)] == [1.0] * 4 and len({tuple(v) for v in vec(train)}) == 3
    assert vec(spark.createDataFrame([(1.0, "zz", 0)], train.schema)) == [[0.0, 0.0, 0.0]]
    assert prep.transform(train).columns == ["x", "kind", "y", "features"]
    assert prep.transform(train).where("kind is null").count() == 1


def test_wide_category_is_hashed_on_request(spark):
    df = spark.range(30000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("kind"), F.col("id").alias("x"))
    x = M.Preprocessor(hashed={"kind": 64}).fit(df).transform(df)
    assert x.first().features.size == 65
    assert M.Preprocessor().fit(df.limit(12000)).transform(df.limit(12000)).first().features.size == 12001


def test_feature_table_needs_a_unique_key(spark):
    ok = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, f double")
    assert M.feature_table(ok, "k") is ok
    for bad in ([(1, 2.0), (1, 3.0)], [(None, 1.0)]):
        with pytest.raises(ValueError):
            M.feature_table(spark.createDataFrame(bad, "k int, f double"), "k")
    base = spark.createDataFrame([(1, "Good"), (3, "Bad")], "k int, quality string")
    t = M.training_set(base, ok, "k", ["f"], "quality", exclude=["k"])
    assert t.columns == ["f", "quality"]
    assert sorted(map(tuple, M.binarize(t, "quality", "Good").collect()), key=repr) == [(2.0, 1), (None, 0)]


def test_split_is_stable(spark):
    df = spark.range(20000).toDF("k")
    a = M.split(df, "k")
    assert a.exceptAll(M.split(df.repartition(9), "k")).isEmpty()
    n = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert abs(n["train"] / 20000 - 0.7) < 0.02 and abs(n["valid"] / 20000 - 0.2) < 0.02 and abs(n["test"] / 20000 - 0.1) < 0.02


@pytest.fixture(scope="module")
def data(spark):
    d = spark.range(3000).select((F.rand(1) * 4 - 2).alias("x"), (F.rand(2) * 4 - 2).alias("noise"), F.when(F.rand(3) < 0.5, "a").otherwise("b").alias("kind"))
    d = d.withColumn("label", (F.col("x") > 0).cast("int")).cache()
    prep = M.Preprocessor("label").fit(d)
    return d, prep, prep.transform(d).cache()


def test_models_learn(data):
    _, prep, x = data
    for est in (M.random_forest(trees=5, depth=4), M.boosted_trees(iterations=3), M.neural_net(4, iterations=30), M.logistic()):
        s = M.score(est.fit(x), x)
        assert M.auc(s, "label") > 0.95
        m = M.classification_metrics(s, "label").first()
        assert m.tp + m.fp + m.fn + m.tn == 3000 and m.accuracy > 0.9


def test_search_and_comparison(data):
    _, _, x = data
    model, trials = M.search(x, trials=2, parallelism=2)
    assert trials.count() == 2 and trials.where("auc > 0.9").count() == 2
    c = M.compare(x, x, {"lr": M.logistic(), "rf": M.random_forest(trees=3, depth=3)})
    assert c.count() == 2 and c.first().auc >= c.collect()[1].auc
    late = M.compare(x, x, {"lr": M.logistic(), "rf": M.random_forest(trees=3, depth=3)}, time_limit=0).collect()
    assert {r.model for r in late} == {"lr", "rf"} and late[-1].auc is None and late[-1].status.startswith("not fitted")


def test_partial_dependence_rises(data):
    d, prep, x = data
    pd = M.partial_dependence(M.logistic().fit(x), prep, d, "x", [-1.5, 0.0, 1.5]).orderBy("grid").collect()
    assert [r.n for r in pd] == [3000] * 3 and pd[0].mean_probability < pd[1].mean_probability < pd[2].mean_probability
