"""Standard errors and p-values of least squares, for many groups at once.

As in :mod:`ledgerline.models.least_squares`, Spark reduces a group to its count, means and covariances in one
aggregation; what follows works on these small arrays, all groups of a batch together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ledgerline.models.least_squares import centred_moments

_COLUMNS = ["coefficient", "std_error", "t", "p_value"]
_RESULT = StructType([StructField(name, ArrayType(DoubleType())) for name in _COLUMNS])


def two_sided(t: np.ndarray, freedom: np.ndarray) -> np.ndarray:
    """Probability that a t variable is at least as far from zero: the incomplete beta function of freedom / (freedom + t^2)
    with parameters freedom / 2 and 1/2, by its continued fraction (Lentz's form)."""
    from math import lgamma

    t, freedom = np.broadcast_arrays(np.asarray(t, float), np.asarray(freedom, float))
    x = freedom / (freedom + t * t)
    a, b = freedom / 2, np.full(t.shape, 0.5)
    swap = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    gamma = np.vectorize(lgamma, otypes=[float])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(gamma(a + b) - gamma(a) - gamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    tiny = 1e-300
    c, d = np.ones(t.shape), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    total = d.copy()
    for m in range(1, 300):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            total = total * c * d
        if np.all(np.abs(c * d - 1) < 1e-15):
            break
    found = np.where(x <= 0, 0.0, front * total)
    return np.clip(np.where(swap, 1 - found, found), 0.0, 1.0)


def _solve(n: int, mean: np.ndarray, cov: np.ndarray, intercept: bool) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Coefficients (the intercept last), their standard errors and the degrees of freedom; None if the features depend on
    each other or leave no freedom."""
    k = len(mean) - 1
    # Without an intercept the moments are about zero instead of about the means.
    moments = cov if intercept else cov + np.outer(mean, mean)
    scale = np.sqrt(np.diag(moments))[:k]
    freedom = n - k - int(intercept)
    if freedom <= 0 or (scale <= 0).any():
        return None
    square = moments[:k, :k] / np.outer(scale, scale)
    if np.linalg.matrix_rank(square, tol=1e-10) < k:
        return None
    inverse = np.linalg.inv(square) / np.outer(scale, scale)
    side = moments[:k, k]
    found = inverse @ side
    # The mean squared residual about the means, and the square of the mean residual: no large sums are subtracted.
    level = 0.0 if intercept else float(mean[k] - found @ mean[:k])
    spread = float(cov[k, k] - 2 * found @ cov[:k, k] + found @ cov[:k, :k] @ found)
    rest = (max(spread, 0.0) + level**2) * n / freedom
    errors = np.sqrt(rest * np.diag(inverse) / n)
    if intercept:
        found = np.append(found, mean[k] - found @ mean[:k])
        errors = np.append(errors, np.sqrt(rest * (1 + mean[:k] @ inverse @ mean[:k]) / n))
    return found, errors, freedom


def _inference(intercept: bool):
    @pandas_udf(_RESULT)
    def infer(n: pd.Series, mean: pd.Series, cov: pd.Series) -> pd.DataFrame:
        solved = []
        for rows, means, flat in zip(n, mean, cov):
            means = np.asarray(means, float)
            solved.append(_solve(int(rows), means, np.asarray(flat, float).reshape(len(means), -1), intercept))
        width = len(mean.iloc[0]) - 1 + int(intercept) if len(mean) else 0
        none = (np.full(width, np.nan), np.full(width, np.nan), 1)
        b, errors, freedom = zip(*[s or none for s in solved]) if solved else ((), (), ())
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.array(b) / np.array(errors)
            p = np.where(np.isnan(t), np.nan, two_sided(np.nan_to_num(t), np.array(freedom)[:, None])) if solved else t
        columns = {"coefficient": b, "std_error": errors, "t": t, "p_value": p}
        plain = {name: [[None if np.isnan(v) else float(v) for v in row] for row in rows] for name, rows in columns.items()}
        return pd.DataFrame(plain)

    return infer


def grouped_inference(
    df: DataFrame, key: Sequence[str], features: Sequence[str], label: str, intercept: bool = True
) -> DataFrame:
    """``(key, n, feature, coefficient, std_error, t, p_value)`` of an ordinary regression per group, ``intercept`` last.

    All four are null where a group's features are constant or depend on each other, or where it has no more rows than
    coefficients. Rows with a missing value are left out; a null key is a group of its own.
    """
    names = [*features, *(["intercept"] if intercept else [])]
    fitted = centred_moments(df, key, features, label).where("n > 0")
    fitted = fitted.withColumn("r", _inference(intercept)("n", "mean", "cov"))
    rows = F.arrays_zip(F.lit(names).alias("feature"), *[F.col(f"r.{c}").alias(c) for c in _COLUMNS])
    return fitted.select(*key, "n", F.inline(rows).alias("feature", *_COLUMNS))
