"""Features, splits, preprocessing, classifiers and evaluation as Spark jobs."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.scalar import h_concentration, log_ratio
from ..sources.files import key_share
from .cells import CellModel, Trainer
from .skew import ordered_scan

MISSING = "(missing)"  # the encoder refuses an empty category name


# --- features ---------------------------------------------------------------------------------------


def derive_features(df: DataFrame, ph: str, acid: str, sugar: str) -> DataFrame:
    """Hydrogen ion concentration and log acidity ratio."""
    return df.withColumns({"h_concentration": h_concentration(F.col(ph)), "acidity_ratio": log_ratio(F.col(acid), F.col(sugar))})


def feature_table(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """A feature table must have one row per key and no NULL key."""
    key = [key] if isinstance(key, str) else list(key)
    bad = df.groupBy(*key).count().where(F.expr(" or ".join(["count > 1", *[f"`{k}` is null" for k in key]])))
    if not bad.isEmpty():
        raise ValueError(f"{key} is not a unique, complete key")
    return df


def lookup_features(base: DataFrame, features: DataFrame, key: str | Sequence[str], names: Sequence[str]) -> DataFrame:
    """Left join chosen features by key; rows without features keep NULLs."""
    key = [key] if isinstance(key, str) else list(key)
    return base.drop(*[n for n in names if n in base.columns]).join(features.select(*key, *names), key, "left")


def training_set(base: DataFrame, features: DataFrame, key: str, names: Sequence[str], label: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Base rows with looked-up features, without the excluded columns, label last."""
    j = lookup_features(base, features, key, names)
    cols = [c for c in j.columns if c != label and c not in exclude]
    return j.select(*cols, label)


def binarize(df: DataFrame, label: str, positive: str) -> DataFrame:
    """1 where the label equals the positive value, else 0."""
    return df.withColumn(label, F.coalesce(F.col(label) == positive, F.lit(False)).cast("int"))


def split(df: DataFrame, key: str | Sequence[str], weights: Mapping[str, float] | None = None, seed: int = 42, out: str = "split") -> DataFrame:
    """Assign every key to a split by its hash: the same rows on every run, retry and cluster."""
    weights = dict(weights or {"train": 0.7, "valid": 0.2, "test": 0.1})
    key = [key] if isinstance(key, str) else list(key)
    u, upto, col = key_share(key, seed), 0.0, None
    names = list(weights)
    for n in names[:-1]:
        upto += weights[n] / sum(weights.values())
        cond = u < upto
        col = F.when(cond, n) if col is None else col.when(cond, n)
    return df.withColumn(out, col.otherwise(names[-1]) if col is not None else F.lit(names[-1]))


# --- preprocessing ----------------------------------------------------------------------------------


class Preprocessor:
    """Numeric columns: to number, mean for missing, population z-score. Categorical columns: a category for
    missing or empty, one-hot with all zeros for unseen values. Columns named in ``hashed`` ({column: buckets}) are
    hashed to that many indicators instead, which needs no list of their values: for columns with very many. Other
    columns pass through.

    Categories are counted exactly on the executors. The ``most`` most frequent of a column (ties by name) get an indicator each, and only
    they come to the driver. Where there are more, the others, and values never seen, share ``tail`` indicators by hash."""

    def __init__(self, label: str | None = None, exclude: Sequence[str] = (), hashed: Mapping[str, int] | None = None, most: int = 20_000, tail: int = 256):
        self.label, self.exclude, self.hashed = label, list(exclude), dict(hashed or {})
        self.most, self.tail = most, tail

    def fit(self, df: DataFrame) -> "Preprocessor":
        use = [f for f in df.schema if f.name != self.label and f.name not in self.exclude]
        self.numeric = [f.name for f in use if isinstance(f.dataType, T.NumericType)]
        self.categorical = [f.name for f in use if isinstance(f.dataType, T.StringType) and f.name not in self.hashed]
        self.stats = numeric_stats(df, self.numeric)
        self.encoder, self.heads, self.tails = None, {}, []
        if self.categorical:
            cat = df.select(*[_category(c).alias(c) for c in self.categorical])
            for c in self.categorical:
                top = [r[0] for r in cat.groupBy(F.col(c).alias("v")).count().orderBy(F.desc("count"), "v").limit(self.most + 1).collect()]
                self.heads[c] = top[: self.most]
                if len(top) > self.most:
                    self.tails.append(c)
            idx = StringIndexerModel.from_arrays_of_labels([self.heads[c] for c in self.categorical], self.categorical, [f"_i_{c}" for c in self.categorical], handleInvalid="keep")
            hot = OneHotEncoder(inputCols=[f"_i_{c}" for c in self.categorical], outputCols=[f"_h_{c}" for c in self.categorical], dropLast=True)
            self.encoder = PipelineModel([idx, hot.fit(idx.transform(cat))])
        return self

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        x = df.withColumns({f"_z_{c}": z_score(c, self.stats) for c in self.numeric})
        parts = [f"_z_{c}" for c in self.numeric]
        if self.encoder:
            # the encoder reads the column names it was fitted on; keep the originals aside
            x = x.withColumnsRenamed({c: f"_keep_{c}" for c in self.categorical})
            x = x.withColumns({c: _category(f"_keep_{c}") for c in self.categorical})
            x = self.encoder.transform(x)
            for c in self.tails:
                rest = x.withColumn(f"_t_{c}", F.when(F.col(f"_i_{c}") >= len(self.heads[c]), F.col(c)))
                x = FeatureHasher(inputCols=[f"_t_{c}"], outputCol=f"_r_{c}", numFeatures=self.tail).transform(rest).drop(f"_t_{c}")
            x = x.drop(*self.categorical, *[f"_i_{c}" for c in self.categorical])
            x = x.withColumnsRenamed({f"_keep_{c}": c for c in self.categorical})
            parts += [f"_h_{c}" for c in self.categorical] + [f"_r_{c}" for c in self.tails]
        for c, buckets in self.hashed.items():
            x = FeatureHasher(inputCols=[f"_c_{c}"], outputCol=f"_b_{c}", numFeatures=buckets).transform(x.withColumn(f"_c_{c}", _category(c)))
            parts.append(f"_b_{c}")
        x = VectorAssembler(inputCols=parts, outputCol=out).transform(x)
        return x.select(*df.columns, out)


def _category(c: str):
    """A missing value and an empty string are one category of their own."""
    return F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit(MISSING))


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of every column after the mean has replaced missing values: one
    aggregate, one row to the driver."""
    if not columns:
        return {}
    aggs = []
    for c in columns:
        x = F.expr(f"try_cast(`{c}` as double)")
        # replacing missing values by the mean adds nothing to the squared deviations but counts in n
        aggs += [F.avg(x).alias(f"m_{c}"), F.var_pop(x).alias(f"v_{c}"), F.count(x).alias(f"k_{c}")]
    r = df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    out = {}
    for c in columns:
        var = (r[f"v_{c}"] or 0.0) * r[f"k_{c}"] / max(r["n"], 1)
        out[c] = (r[f"m_{c}"] or 0.0, var**0.5)
    return out


def z_score(c: str, stats: Mapping[str, tuple[float, float]]):
    m, s = stats[c]
    x = F.coalesce(F.expr(f"try_cast(`{c}` as double)"), F.lit(m))
    return (x - F.lit(m)) / F.lit(s if s > 0 else 1.0)


# --- classifiers ------------------------------------------------------------------------------------


def keep_for_training(df: DataFrame) -> DataFrame:
    """Spread the rows evenly in partitions of the size AQE advises and keep them: trainers pass over them
    many times, so one shuffle pays off when the input has few or uneven partitions."""
    return df.hint("rebalance").persist()


def random_forest(label: str = "label", features: str = "features", trees: int = 20, depth: int = 8, seed: int = 42) -> RandomForestClassifier:
    """Entropy, at least 50 rows per leaf (so a node that is split has at least 100), no bootstrap."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, impurity="entropy", minInstancesPerNode=50, bootstrap=False, numTrees=trees, maxDepth=depth, seed=seed)


def boosted_trees(label: str = "label", features: str = "features", iterations: int = 10, depth: int = 4, seed: int = 42, **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=iterations, maxDepth=depth, seed=seed, **params)


def neural_net(inputs: int, label: str = "label", features: str = "features", iterations: int = 20, seed: int = 42) -> MultilayerPerceptronClassifier:
    """Two hidden layers of 64."""
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=[inputs, 64, 64, 2], blockSize=128, maxIter=iterations, seed=seed)


def logistic(label: str = "label", features: str = "features") -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=20)


def search(train: DataFrame, trials: int = 5, parallelism: int = 10, label: str = "label", seed: int = 42):
    """Random search over boosted trees by validation AUC; returns (best model, rows of trials)."""
    rnd = random.Random(seed)
    gbt = boosted_trees(label)
    grid, table = [], []
    for t in range(trials):
        p = {gbt.maxDepth: rnd.randint(2, 6), gbt.maxIter: rnd.randrange(5, 16, 5), gbt.stepSize: round(rnd.uniform(0.05, 0.5), 3), gbt.subsamplingRate: round(rnd.uniform(0.5, 1.0), 2)}
        b = ParamGridBuilder().baseOn(p)
        grid += b.build()
        table.append({k.name: v for k, v in p.items()})
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    rows = lambda metrics: train.sparkSession.createDataFrame([(i, float(a), str(table[i])) for i, a in enumerate(metrics)], "trial int, auc double, params string")
    part, held = train.randomSplit([0.75, 0.25], seed)
    trainer = Trainer(part.persist(), label).prepare()
    counts = trainer.scored_counts(held)
    part.unpersist()
    if counts is None:
        model = TrainValidationSplit(estimator=gbt, estimatorParamMaps=grid, evaluator=ev, trainRatio=0.75, parallelism=parallelism, seed=seed).fit(train)
        return model.bestModel, rows(model.validationMetrics)
    ev.setLabelCol("label").setWeightCol("w")
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        metrics = list(pool.map(lambda p: ev.evaluate(trainer.fit(gbt.copy(p)).model.transform(counts)), grid))
    trainer.unpersist()
    whole = Trainer(train, label)
    best = whole.fit(gbt.copy(grid[max(range(trials), key=lambda i: metrics[i])]))
    whole.unpersist()
    return best, rows(metrics)


def compare(train: DataFrame, valid: DataFrame, models: Mapping[str, object], label: str = "label", time_limit: float | None = None) -> DataFrame:
    """Fit every model on the same split and rank by validation AUC: one row per model, with a status.

    Models whose turn comes after ``time_limit`` seconds are not fitted and say so; they have no AUC and come last.
    """
    import time

    start, rows, trainer = time.monotonic(), [], Trainer(train, label)
    for name, est in models.items():
        if time_limit is not None and time.monotonic() - start > time_limit:
            rows.append((name, None, "not fitted: time limit"))
            continue
        m = trainer.fit(est)
        rows.append((name, auc_frame(score_counted(trainer, m, valid), label, "probability_1", weight="w").first()[0], "fitted"))
    trainer.unpersist()
    df = train.sparkSession.createDataFrame(rows, "model string, auc double, status string")
    return df.orderBy(F.desc_nulls_last("auc"), "model")


def score(model, df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Class and probability for every row; models without probabilities give their class."""
    s = model.transform(df)
    if "probability" in s.columns:
        s = s.withColumn(out, F.when(F.col("probability").isNotNull(), vector_to_array("probability")[1])).drop("probability")
    else:
        s = s.withColumn(out, F.col("prediction"))
    return s.drop("rawPrediction")


def score_counted(trainer: Trainer, model, valid: DataFrame) -> DataFrame:
    """label, prediction, probability_1 and w, the number of rows: a model of the trainer's cells scores each cell of ``valid`` once."""
    cells = trainer.scored_counts(valid) if isinstance(model, CellModel) else None
    s = score(model, valid).withColumn("w", F.lit(1).cast("long")) if cells is None else score(model.model, cells).withColumnRenamed("label", trainer.label)
    return s.select(trainer.label, "prediction", "probability_1", "w")


# --- evaluation -------------------------------------------------------------------------------------


def auc(df: DataFrame, label: str, score_col: str = "probability_1", ranges: int | None = None) -> float:
    return auc_frame(df, label, score_col, ranges).first()[0]


def auc_frame(df: DataFrame, label: str, score_col: str, ranges: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact ROC AUC with ties counted half, as one row; ``weight`` names a column of whole numbers if a row stands for several.

    Rows are first counted per distinct score; the running count of negatives over the ordered scores is
    an ordered scan of one key, which is dealt to many ranges.
    """
    y, times = (F.col(label) == 1).cast("long"), F.col(weight) if weight else F.lit(1)
    per = df.groupBy(F.col(score_col).alias("s")).agg(F.sum(y * times).alias("p"), F.sum((1 - y) * times).alias("n")).withColumn("g", F.lit(0))
    c = ordered_scan(per, ["g"], ["s"], running={"upto": "n"}, ranges=ranges, spread_equal=False)
    wins = F.sum(F.col("p").cast("double") * (F.col("upto") - F.col("n") / 2.0))
    return c.agg((wins / (F.sum("p").cast("double") * F.sum("n").cast("double"))).alias("auc"))


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 as one row; ``weight`` as for ``auc_frame``."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    count = (lambda c: F.coalesce(F.sum(F.when(c, F.col(weight))), F.lit(0))) if weight else F.count_if
    one = df.agg(count(y & p).alias("tp"), count(~y & p).alias("fp"), count(y & ~p).alias("fn"), count(~y & ~p).alias("tn"))
    d = lambda a, b: F.try_divide(a, b)
    return one.select(
        "tp", "fp", "fn", "tn",
        d(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
        d(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        d(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        d(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def partial_dependence(model, prep: Preprocessor, df: DataFrame, feature: str, grid: Sequence[float], ) -> DataFrame:
    """Mean predicted probability over all rows while one feature is set to every grid value."""
    typ = df.schema[feature].dataType
    wide = df.withColumn("_g", F.explode(F.array(*[F.lit(float(g)) for g in grid]))).withColumn(feature, F.col("_g").cast(typ))
    s = score(model, prep.transform(wide))
    return s.groupBy(F.col("_g").alias("grid")).agg(F.avg("probability_1").alias("mean_probability"), F.count(F.lit(1)).alias("n"))
