import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakekit.operators import ml, profile


@pytest.mark.parametrize("accuracy, few", [(10_000, 100_000), (20, 60)])
def test_exact_quantiles(spark, accuracy, few):
    rnd = random.Random(5)
    cols = {
        "even": [rnd.random() for _ in range(700)],
        "heavy": [rnd.choice([0.0, 0.0, 0.0, 1e-300, 5.0, 1e300]) for _ in range(700)],
        "same": [2.5] * 700,
        "gaps": [None if i % 3 else rnd.gauss(0, 10 ** rnd.randint(0, 12)) for i in range(700)],
        "none": [None] * 700,
    }
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = profile.exact_quantiles(df, list(cols), ps, accuracy, few)
    for c, v in cols.items():
        want = [None] * 6 if c == "none" else np.quantile([x for x in v if x is not None], ps).tolist()
        assert got[c] == (want if c == "none" else pytest.approx(want, rel=1e-12))


def test_exact_profile(spark):
    df = spark.createDataFrame([(float(i % 10), i) for i in range(101)], "a double, b int")
    p = {r.column: r for r in profile.profile(df, approximate=False).collect()}
    assert (p["b"].q1, p["b"].median, p["b"].q3) == (25.0, 50.0, 75.0) and p["a"].distinct == 10
    none = profile.profile(df.where("false"), approximate=False).collect()
    assert [(r["count"], r["median"]) for r in none] == [(0, None), (0, None)]


def test_correlations_with_gaps(spark):
    rnd = random.Random(3)
    rows = [tuple(None if rnd.random() < 0.2 else 1e9 + rnd.gauss(0, 1) * (k + 1) for k in range(4)) + (4.0, None, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, same double, none double, i double")
    want = {(x, y): df.agg(F.corr(x, y)).first()[0] for k, x in enumerate("abcd") for y in "abcd"[k + 1:]}
    for width in (1024, 4):
        got = {(r.a, r.b): r.corr for r in profile.correlations(df, width=width).collect()}
        assert len(got) == 21 and got["a", "same"] is None and got["same", "none"] is None and got["none", "i"] is None
        assert {k: got[k] for k in want} == pytest.approx(want, rel=1e-6, abs=1e-9)
    odd = df.withColumn("b", F.when(F.col("i") == 7, float("inf")).otherwise(F.col("b")))
    got = {(r.a, r.b): r.corr for r in profile.correlations(odd, ["a", "b", "i"]).collect()}
    assert math.isnan(got["b", "i"]) and got["a", "i"] is not None
    assert [r.corr for r in profile.correlations(df.where("false"), ["a", "b"]).collect()] == [None]


def test_correlations_of_a_wide_table(spark):
    x = np.random.default_rng(1).normal(size=(200, 1000))
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"v{i:03d}" for i in range(1000)]))
    got = profile.correlations(df).toPandas().sort_values(["a", "b"])
    want = np.corrcoef(x.T)[np.triu_indices(1000, 1)]
    assert len(got) == 499_500 and np.allclose(got["corr"].to_numpy(), want)


def test_rare_categories_share_hashed_indicators(spark):
    rows = [(i, f"c{i % 40}" if i % 2 else f"rare{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, kind string")
    prep = ml.Preprocessor(exclude=["id"], most=20, tail=8).fit(df)
    assert sorted(prep.heads["kind"]) == sorted(f"c{k}" for k in range(1, 40, 2)) and prep.tails == ["kind"]
    got = {r.kind: r.v for r in prep.transform(df).select("kind", ml.vector_to_array("features").alias("v")).collect()}
    assert all(len(v) == 28 and sum(v) == 1 for v in got.values())
    assert all((sum(v[:20]) == 1) == k.startswith("c") for k, v in got.items())
    assert sum(1 for k in range(20, 28) if any(v[k] for v in got.values())) == 8
    new = prep.transform(spark.createDataFrame([(1, "never seen")], df.schema)).select(ml.vector_to_array("features")).first()[0]
    assert sum(new[20:]) == 1
    whole = ml.Preprocessor(exclude=["id"]).fit(df.where("id % 2 = 1"))
    assert whole.tails == [] and sum(whole.transform(spark.createDataFrame([(1, "never seen")], df.schema)).select(ml.vector_to_array("features")).first()[0]) == 0
