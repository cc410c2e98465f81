"""SQL functions and vectorised Python functions."""

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F


def sql_function(spark: SparkSession, name: str, args: str, body: str, returns: "str | None" = None) -> None:
    """A temporary SQL function. Spark inlines its body into the query, so it is optimised with it."""
    ret = f" RETURNS {returns}" if returns else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}){ret} RETURN {body}")


def literal_function(spark: SparkSession, name: str, value: str) -> None:
    text = value.replace("'", "\\'")
    sql_function(spark, name, "", f"'{text}'")


def lookup_function(spark: SparkSession, name: str, table: str, key: str, value: str, key_type: str = "STRING") -> None:
    """A function that looks its argument up in a table; the smallest value where a key occurs twice.

    Spark turns the correlated subquery into an aggregated left join.
    """
    sql_function(spark, name, f"k_ {key_type}", f"(SELECT min({value}) FROM {table} WHERE {table}.{key} = {name}.k_)")


def lookup_join(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """The same lookup as a join."""
    t = table.groupBy(F.col(key).alias("_k")).agg(F.min(value).alias(out))
    return df.join(t, F.col(col) == F.col("_k"), "left").drop("_k")


def model_function(predict: Callable, features: Sequence[str], returns: str = "double"):
    """A model as a vectorised column function over the named features.

    ``predict`` takes a pandas DataFrame with the feature columns and returns one value per row; batches
    travel by Arrow. The model is shipped with the function to every executor once per task.
    """
    names = list(features)

    def apply(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in batches:
            cols = cols if isinstance(cols, tuple) else (cols,)  # one column comes without a tuple
            yield pd.Series(predict(pd.concat(cols, axis=1, keys=names)))

    return F.pandas_udf(apply, returns)


def register_model(spark: SparkSession, name: str, predict: Callable, features: Sequence[str], returns: str = "double"):
    """The same function under a name for SQL: ``SELECT *, name(*) FROM features``."""
    return spark.udf.register(name, model_function(predict, features, returns))


def linear_predictor(coefficients: Sequence[float], intercept: float, threshold: float | None = None) -> Callable:
    """Probability (or, with a threshold, class) of a fitted logistic model as a pandas function."""
    import numpy as np

    w = np.asarray(list(coefficients), dtype=float)

    def predict(pdf):
        p = 1.0 / (1.0 + np.exp(-(pdf.to_numpy(dtype=float) @ w + intercept)))
        return p if threshold is None else (p >= threshold).astype(float)

    return predict
