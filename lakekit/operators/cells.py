"""Trees grown on cells: rows whose features lie between the same thresholds, and have one label, are one weighted row.

A tree asks of a feature only on which side of a threshold it lies, and Spark chooses the thresholds (at most 31 a feature) from a sample
before it grows anything. So the rows are counted per cell in one pass, and every further pass reads cells, whose number is bounded by thresholds and
features and not by rows. The thresholds follow Spark's rule on a sample of its size; 50 rows per leaf are 50 units of weight; a subsample of rows draws
from every cell's rows by a binomial. Tables below ``least`` rows, those with more than ``widest`` features and those whose cells are more than a
quarter of the rows are given to Spark as they are.
"""

from __future__ import annotations

from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from . import perceptron

LEAST = 1_000_000
WIDEST = 64
SAMPLE = 10_000
BINS = 32
PER_TASK = 20_000  # cells


def thresholds(counts: dict[float, float], rows: float, most: int) -> list[float]:
    """Midpoints between the values of a sample; with more than ``most`` of them, those closest to equal shares of the rows."""
    values = sorted(counts)
    middle = [(a + b) / 2 for a, b in zip(values, values[1:])]
    if len(middle) <= most:
        return middle
    stride = rows / (most + 1)
    out, upto, target = [], counts[values[0]], stride
    for m, v in zip(middle, values[1:]):
        before, upto = upto, upto + counts[v]
        if abs(before - target) < abs(upto - target):
            out.append(m)
            target += stride
    return out


class Binning:
    """The thresholds of every feature; ``None`` for indicators, which keep their values."""

    def __init__(self, df: DataFrame, rows: int, features: str = "features", bins: int = BINS, seed: int = 42):
        meta = df.schema[features].metadata
        attrs = meta.get("ml_attr", {}).get("attrs", {})
        own = {a["idx"] for kind in ("binary", "nominal") for a in attrs.get(kind, [])}
        self.features, self.metadata = features, meta
        share = min(1.0, max(SAMPLE, bins * bins) / rows)
        x = df.select(vector_to_array(features).alias("x"))
        seen = (x if share == 1 else x.sample(share, seed)).select(F.posexplode("x").alias("i", "v")).groupBy("i", "v").count().collect()
        size = 1 + max((r.i for r in seen), default=-1)
        per = [{} for _ in range(size)]
        for r in seen:
            per[r.i][r.v] = float(r["count"])
        self.cuts = [None if i in own else np.array(thresholds(c, sum(c.values()), bins - 1)) for i, c in enumerate(per)]

    def column(self) -> Column:
        """The bins of a row as an array; a value at a threshold lies below it."""
        cuts = self.cuts

        @F.arrow_udf("array<smallint>")
        def bins(x: pa.Array) -> pa.Array:
            v = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts))
            out = np.empty(v.shape, np.int16)
            for i, c in enumerate(cuts):
                out[:, i] = v[:, i] if c is None else np.searchsorted(c, v[:, i])
            return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, len(cuts)), pa.int32()), pa.array(out.ravel()))

        return bins(vector_to_array(F.col(self.features)))

    def vector(self, array: Column) -> Column:
        return array_to_vector(array.cast("array<double>")).alias("bins", metadata=self.metadata)

    def cells(self, df: DataFrame, label: str) -> DataFrame:
        """bins array, label, w"""
        return df.select(self.column().alias("a"), F.col(label).alias("label")).groupBy("a", "label").agg(F.count(F.lit(1)).alias("w"))


class CellModel:
    """A model of bins that takes rows."""

    def __init__(self, binning: Binning, model):
        self.binning, self.model = binning, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df.withColumn("bins", self.binning.vector(self.binning.column()))).drop("bins")


class Trainer:
    """Fits models on one training table. Trees share its cells, nets get its rows in blocks, other models as they are."""

    def __init__(self, df: DataFrame, label: str = "label", features: str = "features", least: int | None = None):
        self.df, self.label, self.features, self.least = df, label, features, LEAST if least is None else least
        self.binning, self._rows, self._cells, self._counted, self._valid = None, None, None, False, None

    def _many(self) -> bool:
        if self._rows is None:
            self._rows = self.df.count()
        return self._rows >= max(1, self.least)

    def _count(self) -> None:
        if self._counted:
            return
        self._counted = True
        if not self._many() or self.df.select(self.features).first()[0].size > WIDEST:
            return
        rows = self._rows
        binning = Binning(self.df, rows, self.features)
        cells = materialize(binning.cells(self.df, self.label))
        n = cells.count()
        if 4 * n <= rows:
            self.binning, self.rows, self.n = binning, rows, n
            # a fixed number of tasks and a fixed order, so that draws do not depend on the cluster
            dealt = cells.repartition(ceil(n / PER_TASK), "a", "label").sortWithinPartitions("a", "label")
            self._cells = dealt.select(binning.vector(F.col("a")), "label", F.col("w").cast("double").alias("w")).persist()

    def prepare(self) -> "Trainer":
        """Counts the cells; call it before fitting from several threads."""
        self._count()
        return self

    def fit(self, est):
        if isinstance(est, MultilayerPerceptronClassifier) and est.getSolver() == "l-bfgs" and self._many():
            return perceptron.fit(est, self.df)
        if not isinstance(est, RandomForestClassifier | GBTClassifier):
            return est.fit(self.df)
        self._count()
        if self._cells is None or est.getMaxBins() != BINS:
            return est.fit(self.df)
        # all cells are asked for their bins (Spark samples maxBins squared), so that none of these is lost
        params = {est.featuresCol: "bins", est.labelCol: "label", est.maxBins: max(BINS, isqrt(self.n) + 2)}
        few = est.getMinInstancesPerNode()
        if few > 1:
            if 2 * few > self.rows:
                return est.fit(self.df)
            params |= {est.minInstancesPerNode: 1, est.minWeightFractionPerNode: (few - 0.5) / self.rows}
        if isinstance(est, RandomForestClassifier) or est.getSubsamplingRate() == 1.0:
            return CellModel(self.binning, est.copy(params | {est.weightCol: "w"}).fit(self._cells))
        return CellModel(self.binning, boosted_on_draws(est.copy(params), self._cells))

    def scored_counts(self, valid: DataFrame) -> DataFrame | None:
        """The validation rows as cells (bins, label, w), for models of this trainer; None where it has no cells."""
        self._count()
        if self._cells is None:
            return None
        if self._valid is None or self._valid[0] is not valid:
            self._valid = valid, materialize(self.binning.cells(valid, self.label))
        return self._valid[1].select(self.binning.vector(F.col("a")), "label", "w")

    def unpersist(self) -> None:
        if self._cells is not None:
            self._cells.unpersist()


def _drawn(batches, rate: float, seed: int, step: int):
    rng = np.random.default_rng([seed % (1 << 32), step, TaskContext.get().partitionId()])
    for b in batches:
        w = rng.binomial(b.column("w").to_numpy().astype(np.int64), rate).astype(float)
        yield b.set_column(b.schema.get_field_index("w"), "w", pa.array(w))


def boosted_on_draws(est: GBTClassifier, cells: DataFrame) -> GBTClassificationModel:
    """Boosting by logistic loss, as ``GBTClassifier`` does it; for every tree each row of a cell is drawn with the subsampling rate."""
    spark, rate, seed = cells.sparkSession, est.getSubsamplingRate(), est.getSeed()
    tree = DecisionTreeRegressor(
        featuresCol="bins", labelCol="t", weightCol="w", maxDepth=est.getMaxDepth(), maxBins=est.getMaxBins(), minInstancesPerNode=est.getMinInstancesPerNode(),
        minWeightFractionPerNode=est.getMinWeightFractionPerNode(), minInfoGain=est.getMinInfoGain(), impurity="variance", seed=seed, predictionCol="p",
    )
    y = 2 * F.col("label") - 1.0
    state, trees, steps, held = cells.withColumn("f", F.lit(0.0)), [], [], None
    meta = cells.schema["bins"].metadata
    for i in range(est.getMaxIter()):
        target = y if i == 0 else 4 * y / (1 + F.exp(2 * y * F.col("f")))
        rows = state.select(vector_to_array("bins").alias("x"), target.alias("t"), "w")
        drawn = rows.mapInArrow(lambda bs, i=i: _drawn(bs, rate, seed, i), "x array<double>, t double, w double").where("w > 0")
        drawn = drawn.select(array_to_vector("x").alias("bins", metadata=meta), "t", "w").persist()
        drawn.count()
        model = tree.fit(drawn)
        drawn.unpersist()
        trees.append(model)
        steps.append(1.0 if i == 0 else est.getStepSize())
        after = model.transform(state).select("bins", "label", "w", (F.col("f") + steps[-1] * F.col("p")).alias("f")).persist()
        after.count()
        if held is not None:
            held.unpersist()
        state = held = after
    if held is not None:
        held.unpersist()
    return _boosted_model(spark, est, trees, steps)


def _boosted_model(spark, est: GBTClassifier, trees: list, steps: list[float]) -> GBTClassificationModel:
    sc = spark.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    parts = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, (t, s) in enumerate(zip(trees, steps)):
        parts[i], weights[i] = t._java_obj, s
    made = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(est.uid, parts, weights))
    return made.setFeaturesCol("bins")
