"""The mini-batch network against numerical derivatives, a replay on one task and what it has to learn."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakekit.operators import ml as M, nets as N


def test_gradient_equals_central_differences():
    rng = np.random.default_rng(3)
    shape = N.Shape(5, (7, 4))
    net = N.Net(shape, seed=1)
    net.flat += rng.normal(0, 0.1, len(net.flat))
    x, y = rng.normal(size=(20, 5)), rng.integers(0, 2, 20).astype(float)
    mask = (rng.random((20, 4)) < 0.9) / 0.9
    _, grad, _ = net.gradient(x, y, mask)
    for i in range(len(grad)):
        at, h = net.flat[i], 1e-6
        net.flat[i] = at + h
        up = net.gradient(x, y, mask)[0]
        net.flat[i] = at - h
        down = net.gradient(x, y, mask)[0]
        net.flat[i] = at
        assert abs((up - down) / (2 * h) - grad[i]) < 1e-6


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 256, 257, 1000])
def test_mini_batches_hold_every_row_once(n):
    x, y = np.arange(n, dtype=float)[:, None], np.arange(n, dtype=float)
    blocks = [(x[i : i + 90], y[i : i + 90]) for i in range(0, n, 90)]
    got = list(N.mini_batches(iter(blocks), 128, np.random.default_rng(0)))
    assert sorted(v for _, b in got for v in b) == list(range(n))
    assert all((a[:, 0] == b).all() and len(b) <= 128 for a, b in got)
    assert n == 1 or all(len(b) > 1 for _, b in got)


@pytest.fixture(scope="module")
def data(spark):
    d = spark.range(6000, numPartitions=6).select("id", F.array(F.rand(1) * 4 - 2, F.rand(2) * 4 - 2, F.rand(3)).alias("features"))
    return d.withColumn("label", (F.col("features")[0] * F.col("features")[1] > 0).cast("int")).cache()  # no linear model tells these apart


def test_learns_what_is_not_linear(spark, data):
    model = N.NetClassifier(epochs=12, rate=0.01, rounds=2).fit(data)
    h = model.history(spark).groupBy("epoch").agg(F.sum("n").alias("n"), F.avg("loss").alias("loss")).orderBy("epoch").collect()
    assert [r.n for r in h] == [6000] * 12 and h[-1].loss < 0.6 * h[0].loss
    s = M.score(model, data)
    assert s.columns == ["id", "features", "label", "prediction", "probability_1"] and M.auc(s, "label") > 0.95
    m = M.classification_metrics(s, "label").first()
    assert m.tp + m.fp + m.fn + m.tn == 6000 and m.accuracy > 0.88


def test_one_task_equals_a_replay(spark, data):
    rows = data.where("id < 500").coalesce(1)
    got = N.NetClassifier(hidden=(8,), epochs=1, batch=50, rounds=1).fit(rows).net
    local = rows.collect()
    x, y = np.array([r.features for r in local]), np.array([float(r.label) for r in local])
    net, rng = N.Net(N.Shape(3, (8,)), seed=42), np.random.default_rng([42, 0, 0, 0])
    for bx, by in N.mini_batches(iter([(x, y)]), 50, rng):
        net.step(bx, by, rng)
    assert np.allclose(got.state, net.state)


def test_average_is_weighted_by_rows(spark, data):
    rows = data.where("id < 1500 or id >= 5900")  # tasks of 1000, 500, none and 100 rows
    local = rows.orderBy("id").collect()
    c = N.NetClassifier(hidden=(8,), epochs=1, rounds=1, groups=2)
    model = c.fit(rows)
    want, n = 0.0, 0
    for p in (0, 1, 5):
        part = [r for r in local if r.id // 1000 == p]
        net, rng = N.Net(N.Shape(3, (8,)), seed=42), np.random.default_rng([42, 0, 0, p])
        block = np.array([r.features for r in part]), np.array([float(r.label) for r in part])
        for bx, by in N.mini_batches(iter([block]), 128, rng):
            net.step(bx, by, rng)
        want, n = want + len(part) * net.state, n + len(part)
    assert n == 1600 and np.allclose(model.net.state, want / n)
    assert np.array_equal(c.fit(rows).net.state, model.net.state)


def test_nulls_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1, "a"), (None, 1, "b"), ([3.0, None], 0, "c"), ([0.5, 1.0], None, "d"), ([0.0, 1.0], 0, "e")], "features array<double>, label int, probability string")
    model = N.NetClassifier(rounds=1, epochs=3).fit(df)
    assert [r.n for r in model.history(spark).collect()] == [2, 2, 2]
    s = M.score(model, df).collect()
    assert [r.probability_1 is None for r in s] == [False, True, True, False, False] and [r.prediction is None for r in s] == [False, True, True, False, False]
    none = N.NetClassifier().fit(df.where("label > 5"))
    assert none.history(spark).count() == 0 and none.net.shape.inputs == 0
    assert M.score(none, df.where("features is null")).first().probability_1 is None
