"""Shapley values against enumeration, and the parameter search against random draws."""

import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakekit.operators import attribution as AT, ml as M, tuning as TU


def predicted(paths, x, known):
    """The forest's value when only the features in ``known`` are given: other conditions count by their shares."""
    total = 0.0
    for p in paths:
        w = p.value
        for f, low, high, cats, share in zip(p.features, p.low, p.high, p.categories, p.share):
            w *= (low < x[f] <= high and (cats is None or x[f] in cats)) if f in known else share
        total += w
    return total


def enumerated(paths, x):
    n = len(x)
    out = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        out.append(sum(factorial(len(s)) * factorial(n - 1 - len(s)) / factorial(n) * (predicted(paths, x, {*s, i}) - predicted(paths, x, set(s))) for k in range(n) for s in combinations(rest, k)))
    return out


@pytest.fixture(scope="module")
def forest(spark):
    d = spark.range(2000).select((F.rand(1) * 4 - 2).alias("x"), F.rand(2).alias("y"), F.rand(3).alias("noise"), F.when(F.rand(4) < 0.5, "a").otherwise("b").alias("kind"))
    d = d.withColumn("label", (F.col("x") + F.when(F.col("kind") == "a", 1).otherwise(0) * F.col("y") > 0.3).cast("int")).cache()
    prep = M.Preprocessor("label").fit(d)
    x = prep.transform(d).select("features", "label").cache()
    return M.random_forest(trees=5, depth=5).fit(x), x


def test_values_equal_enumeration_and_add_up(forest):
    model, x = forest
    paths = AT.paths_of(model)
    assert max(len(p.features) for p in paths) >= 3 and any(c is not None for p in paths for c in p.categories)
    scored = M.score(model, x)
    got = AT.attributions(model, scored, keep=["probability_1", "features"]).collect()
    assert len(got) == 2000
    assert max(abs(r.base + sum(r.attribution) - r.probability_1) for r in got) < 1e-9
    for r in got[:40]:
        assert np.allclose(r.attribution, enumerated(paths, r.features.toArray()), atol=1e-10)


def test_paths_are_worked_out_once_for_many_batches(monkeypatch):
    rnd = np.random.default_rng(1)
    at = np.cumsum(rnd.random((12, 3)), 1) - 1.5
    paths = [AT.Path((0, 1, 3), (-np.inf, a, -np.inf), (b, c, np.inf), (None, None, frozenset([1.0, 2.0])), (0.5, 0.25, 0.75), 1.0 + a) for a, b, c in at] + [AT.Path((), (), (), (), (), 1.0)]
    x = np.concatenate([rnd.normal(size=(300, 3)), rnd.integers(0, 4, (300, 1))], 1)
    plain, known, calls, whole = AT.shapley(paths, x), AT.tables(paths), [], AT.path_values
    assert np.allclose(plain[:40], [enumerated(paths, r) for r in x[:40]])
    monkeypatch.setattr(AT, "path_values", lambda *a: calls.append(1) or whole(*a))
    assert np.allclose(np.concatenate([AT.shapley(paths, part, known) for part in np.array_split(x, 10)]), plain, rtol=1e-12, atol=1e-15) and not calls
    some = AT.tables(paths, most_bytes=5 * 8 * 3 << 3)  # room for five tables: the other paths take what occurs
    assert [t is not None for t in some] == [True] * 5 + [False] * 8 and np.allclose(AT.shapley(paths, x, some), plain, rtol=1e-12, atol=1e-15)


def test_repeated_features_and_unused_ones():
    """Bounds of one feature are one condition; a feature on no path has no value."""
    paths = [AT.Path((0,), (1.0,), (2.0,), (None,), (0.25,), 8.0), AT.Path((0, 2), (-np.inf, 0.0), (1.0, np.inf), (None, None), (0.5, 0.5), 4.0), AT.Path((), (), (), (), (), 1.0)]
    x = np.array([[1.5, 9.0, 1.0], [0.5, 9.0, 1.0], [3.0, 9.0, -1.0]])
    got = AT.shapley(paths, x)
    assert np.allclose(got, [enumerated(paths, r) for r in x]) and (got[:, 1] == 0).all()
    assert AT.base_value(paths) == 8 * 0.25 + 4 * 0.25 + 1


def test_large_forest_is_refused(forest):
    model, x = forest
    with pytest.raises(ValueError, match="bytes"):
        AT.attributions(model, x, most_bytes=100)


def test_attribution_by_feature(forest):
    model, x = forest
    names = ["x", "y", "noise", *[f"k{i}" for i in range(x.first().features.size - 3)]]
    rows = AT.by_feature(AT.attributions(model, x), names).collect()
    assert rows[0].feature == "x" and {r.n for r in rows} == {2000}
    assert AT.attributions(model, x.where("false")).count() == 0


SPACE = {"a": TU.Range(0, 1), "b": TU.Range(1e-4, 1, scale="log"), "c": TU.Range(1, 20, True)}


def surface(p):
    return -((p["a"] - 0.3) ** 2) - (SPACE["b"].inner(p["b"]) - 0.8) ** 2 - ((p["c"] - 6) / 20) ** 2


def test_proposals_beat_random_draws():
    best = lambda trials: max(t.value for t in trials)
    told = [best(TU.maximise(surface, SPACE, 40, seed=s)) for s in range(12)]
    drawn = [best(TU.maximise(surface, SPACE, 40, seed=s, at_random=40)) for s in range(12)]
    assert np.mean(told) > 0.5 * np.mean(drawn) and sum(a > b for a, b in zip(told, drawn)) >= 8


def test_all_trials_come_back_and_run_together():
    import threading
    import time

    running, most, lock = [0], [0], threading.Lock()

    def slow(p):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.02)
        with lock:
            running[0] -= 1
        return p["a"]

    got = TU.maximise(slow, SPACE, 12, parallelism=4)
    assert [t.number for t in got] == list(range(12)) and 2 <= most[0] <= 4
    assert all(isinstance(t.parameters["c"], int) and 1 <= t.parameters["c"] <= 20 and 1e-4 <= t.parameters["b"] <= 1 for t in got)
    with pytest.raises(ZeroDivisionError):
        TU.maximise(lambda p: 1 / 0, SPACE, 3)


def test_proposals_do_not_depend_on_which_trial_ends_first():
    import time

    def waits(of):
        def value(p):
            time.sleep(of(p))
            return surface(p)

        return TU.maximise(value, SPACE, 14, parallelism=4, seed=1)

    quick, slow = waits(lambda p: 0.03 * p["a"]), waits(lambda p: 0.03 * (1 - p["a"]))
    assert quick == slow and [t.number for t in quick] == list(range(14))


def test_parzen_query_proposes_from_ended_trials(spark, monkeypatch, tmp_path):
    """What the trials scored decides the parameters of later ones."""
    from lakekit.plans import q_ml

    rows = [(i // 4, i % 4, i % 50, float(1 + i % 9), float(1500 + (i * 7919) % 9000), 0.01 * (i % 7), 0.01 * (i % 5), "OF"[i % 2]) for i in range(600)]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_linestatus string"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    known, proposed, whole = [], [], TU.propose

    def watched(space, ended, rnd):
        known.append([t.number for t in ended])
        proposed.append(whole(space, ended, rnd))
        return proposed[-1]

    monkeypatch.setattr(TU, "propose", watched)
    got = q_ml.m11_parzen(spark, str(tmp_path)).orderBy("trial").collect()
    assert [r.trial for r in got] == list(range(16)) and all(0.5 < r.auc <= 1 for r in got)
    assert known == [list(range(n - 3)) for n in range(8, 16)]
    assert [[r[k] for k in TU.BOOSTED] for r in got[8:]] == [[float(p[k]) for k in TU.BOOSTED] for p in proposed]
    one, other = (TU.maximise(f, SPACE, 16, parallelism=4) for f in (surface, lambda p: -surface(p)))
    assert [t.parameters == u.parameters for t, u in zip(one, other)] == [True] * 8 + [False] * 8


def test_search_and_halving_on_models(forest):
    _, x = forest
    keyed = x.withColumn("id", F.monotonically_increasing_id()).cache()
    small = {"maxDepth": TU.Range(2, 3, True), "maxIter": TU.Range(1, 2, True), "stepSize": TU.Range(0.05, 0.5, scale="log")}
    model, trials = TU.search_boosted(x, x, trials=3, parallelism=3, space=small)
    rows = trials.collect()
    assert [r.trial for r in rows] == [0, 1, 2] and all(0.5 < r.auc <= 1 and r.maxDepth in (2, 3) for r in rows)
    assert abs(M.auc(M.score(model, x), "label") - max(r.auc for r in rows)) < 1e-12
    models = {"flat": M.boosted_trees(iterations=1, depth=1), "forest": M.random_forest(trees=5, depth=4), "line": M.logistic()}
    ranked = TU.halving(keyed, keyed, models, ["id"], start=0.5).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3] and ranked[0].share == 1.0 and ranked[-1].status == "dropped" and ranked[-1].auc is not None
    late = TU.halving(keyed, keyed, models, ["id"], time_limit=0).collect()
    assert {r.status for r in late} == {"not fitted: time limit"}
