"""Trees on cells against the same trees on rows."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from lakekit.operators import cells as C, ml as M, tuning as TU


@pytest.fixture(scope="module")
def rows(spark):
    """8,000 rows of few cells: 40 values, 7 values, and a category."""
    rng = np.random.default_rng(3)
    a, b, k = rng.integers(0, 40, 8000), rng.integers(0, 7, 8000), rng.integers(0, 3, 8000)
    y = (a * 0.3 + b + 2.0 * (k == 1) + rng.normal(0, 2, 8000) > 9).astype(int)
    df = spark.createDataFrame([(int(i), float(p), float(q), f"k{z}", int(t)) for i, (p, q, z, t) in enumerate(zip(a, b, k, y))], "id long, a double, b double, kind string, label int")
    x = M.Preprocessor("label", exclude=["id"]).fit(df).transform(df)
    return x.select("id", "features", "label").repartition(3).cache()


def scores(model, rows):
    return np.array([r[0] for r in M.score(model, rows).orderBy("id").select("probability_1").collect()])


@pytest.mark.parametrize("make", [lambda: M.random_forest(trees=5, depth=5), lambda: M.boosted_trees(iterations=4)])
def test_cells_grow_the_trees_of_the_rows(rows, make):
    est = make()
    trainer = C.Trainer(rows, least=1)
    on_cells = trainer.fit(est)
    assert isinstance(on_cells, C.CellModel) and trainer.n < 2000
    assert np.abs(scores(on_cells, rows) - scores(est.fit(rows), rows)).max() < 1e-9
    trainer.unpersist()


def test_draws_follow_the_rate_and_repeat(rows):
    est = M.boosted_trees(iterations=5, subsamplingRate=0.6)
    one, two = (scores(C.Trainer(rows, least=1).fit(est), rows) for _ in range(2))
    full = scores(C.Trainer(rows, least=1).fit(M.boosted_trees(iterations=5)), rows)
    assert (one == two).all() and (one != full).any()
    of = lambda model: M.auc(M.score(model, rows), "label")
    assert abs(of(C.Trainer(rows, least=1).fit(est)) - of(est.fit(rows))) < 0.01


def test_boosting_on_draws_of_all_rows_is_boosting(rows):
    est = M.boosted_trees(iterations=4)
    trainer = C.Trainer(rows, least=1).prepare()
    drawn = C.boosted_on_draws(est.copy({est.featuresCol: "bins", est.maxBins: 128}), trainer._cells)
    assert np.abs(scores(C.CellModel(trainer.binning, drawn), rows) - scores(est.fit(rows), rows)).max() < 1e-9


def test_small_and_scattered_tables_go_to_spark_as_they_are(spark, rows):
    assert isinstance(C.Trainer(rows).fit(M.random_forest(trees=2, depth=2)), RandomForestClassificationModel)
    scattered = C.Trainer(rows.where("id < 300"), least=1)
    assert isinstance(scattered.fit(M.random_forest(trees=2, depth=2)), RandomForestClassificationModel)
    assert scattered.scored_counts(rows) is None


def test_validation_cells_score_like_rows(rows):
    trainer = C.Trainer(rows, least=1)
    model = trainer.fit(M.boosted_trees(iterations=3, subsamplingRate=0.8))
    counts = trainer.scored_counts(rows)
    assert counts.count() < 2000 and counts.agg(F.sum("w")).first()[0] == 8000
    by_cell = M.auc_frame(M.score(model.model, counts), "label", "probability_1", weight="w").first()[0]
    assert abs(by_cell - M.auc(M.score(model, rows), "label")) < 1e-12


def test_searches_and_halving_on_cells(rows, monkeypatch):
    monkeypatch.setattr(C, "LEAST", 1)
    small = {"maxDepth": TU.Range(2, 3, True), "maxIter": TU.Range(2, 3, True), "subsamplingRate": TU.Range(0.5, 1.0)}
    best, trials = TU.search_boosted(rows, rows, trials=3, parallelism=3, space=small)
    assert isinstance(best, C.CellModel) and abs(M.auc(M.score(best, rows), "label") - max(r.auc for r in trials.collect())) < 1e-12
    best, trials = M.search(rows.select("features", "label"), trials=2, parallelism=2)
    assert isinstance(best, C.CellModel) and all(r.auc > 0.8 for r in trials.collect())
    got = TU.halving(rows, rows, {"forest": M.random_forest(trees=3, depth=3), "boosted": M.boosted_trees(iterations=2)}, ["id"], start=0.5).collect()
    assert got[0].share == 1.0 and all(r.auc > 0.8 for r in got)


def test_reports_score_cells_once(rows, monkeypatch):
    """Counts of cells give the metrics and the AUC of the rows; both models share one table of cells."""
    train, valid = rows.where("id % 3 > 0"), rows.where("id % 3 = 0").drop("id")
    trainer, made = C.Trainer(train, least=1), []
    count = C.Binning.cells
    monkeypatch.setattr(C.Binning, "cells", lambda *a: made.append(1) or count(*a))
    for est in (M.random_forest(trees=5, depth=5), M.boosted_trees(iterations=4)):
        model = trainer.fit(est)
        got, want = M.score_counted(trainer, model, valid), M.score(model, valid)
        assert got.count() < valid.count() / 2
        assert M.classification_metrics(got, "label", weight="w").first() == M.classification_metrics(want, "label").first()
        assert abs(M.auc_frame(got, "label", "probability_1", weight="w").first()[0] - M.auc(want, "label")) < 1e-12
    assert len(made) == 2
    spread = M.score_counted(trainer, M.logistic().fit(train), valid)
    assert spread.agg(F.sum("w")).first()[0] == valid.count()
    trainer.unpersist()
