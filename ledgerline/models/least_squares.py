"""Least squares for many groups at once.

Spark reduces each group to its moment matrices in one map-side combined aggregation; only these small arrays
(k x k for k regressors) reach Python, where a vectorised function solves them. A group's rows are never brought
together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType


def grouped_regression(
    df: DataFrame, key: Sequence[str], features: Sequence[str], label: str, intercept: bool = True
) -> DataFrame:
    """``(key, n, feature, coefficient)`` of an ordinary regression per group; null coefficients where the group's
    features are linearly dependent, so that there is no single answer.

    The moments are taken about the group's means, in Spark's one-pass form, and scaled: sums of raw products would lose
    all digits when means are large beside deviations. Without an intercept they are then moved to zero.
    """
    names = [*features, *(["intercept"] if intercept else [])]
    solved = _solve_centred("mean", "cov") if intercept else _solve_about_zero("mean", "cov")
    fitted = centred_moments(df, key, features, label).withColumn("coefficients", solved)
    pairs = F.arrays_zip(F.lit(names).alias("feature"), F.col("coefficients").alias("coefficient"))
    return fitted.select(*key, "n", F.inline(pairs).alias("feature", "coefficient"))


def centred_moments(df: DataFrame, key: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """Per group: ``n``, the means and the row-major population covariances of the features and the label."""
    columns = [F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate([*features, label])]
    rows = df.select(*key, *columns).na.drop(subset=[f"_v{i}" for i in range(len(columns))])
    k = range(len(columns))
    aggregates = [F.avg(f"_v{i}").alias(f"_m{i}") for i in k]
    aggregates += [F.covar_pop(f"_v{i}", f"_v{j}").alias(f"_c{i}_{j}") for i in k for j in k if i <= j]
    summed = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *aggregates)
    square = [F.col(f"_c{min(i, j)}_{max(i, j)}") for i in k for j in k]
    return summed.select(*key, "n", F.array(*[f"_m{i}" for i in k]).alias("mean"), F.array(*square).alias("cov"))


@pandas_udf(ArrayType(DoubleType()))
def _solve_centred(mean: pd.Series, cov: pd.Series) -> pd.Series:
    def one(means, moments_):
        means = np.asarray(means, float)
        k = len(means) - 1
        square = np.asarray(moments_, float).reshape(k + 1, k + 1)
        scale = np.sqrt(np.diag(square))[:k]
        if not k or (scale == 0).any():
            return [None] * (k + 1) if k else [float(means[0])]
        correlated = square[:k, :k] / np.outer(scale, scale)
        if np.linalg.matrix_rank(correlated, tol=1e-10) < k:
            return [None] * (k + 1)
        found = np.linalg.solve(correlated, square[:k, k] / scale) / scale
        return [*found.tolist(), float(means[k] - found @ means[:k])]

    return pd.Series([one(*row) for row in zip(mean, cov)])


@pandas_udf(ArrayType(DoubleType()))
def _solve_about_zero(mean: pd.Series, cov: pd.Series) -> pd.Series:
    def one(means, moments_):
        means = np.asarray(means, float)
        k = len(means) - 1
        square = np.asarray(moments_, float).reshape(k + 1, k + 1) + np.outer(means, means)
        scale = np.sqrt(np.diag(square))[:k]
        if not k or (scale == 0).any():
            return [None] * k
        scaled = square[:k, :k] / np.outer(scale, scale)
        if np.linalg.matrix_rank(scaled, tol=1e-10) < k:
            return [None] * k
        return (np.linalg.solve(scaled, square[:k, k] / scale) / scale).tolist()

    return pd.Series([one(*row) for row in zip(mean, cov)])
