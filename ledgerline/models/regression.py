"""Regression of monthly volume on macro factors and lagged volume."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.series import add_lags, positional_split
from ledgerline.operators.stats import constant_columns

FEATURES = ["cpi", "inpi", "totci", "volume_lag_1", "volume_lag_2", "volume_lag_3"]
LABEL = "volume"
MAX_DEPTH = 30  # the deepest tree Spark grows


def regression_frame(volume: DataFrame, factors: DataFrame) -> DataFrame:
    """Monthly volume with factors, log lags and the positional ``split``."""
    joined = volume.join(factors, "month", "left")
    return positional_split(add_lags(joined, LABEL, 3, log=True))


def varying(train: DataFrame, features: Sequence[str]) -> list[str]:
    """Features that vary in the training rows; a constant one makes the equations singular."""
    fixed = set(constant_columns(train.where(F.col("split") == "train"), features))
    return [f for f in features if f not in fixed]


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _complete(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """The rows that a fit can use."""
    return frame.na.drop(subset=[*features, LABEL])


def predictions(model: PipelineModel, frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """Every row with its ``prediction``, null where a feature is missing."""
    known = reduce(and_, [F.col(f).isNotNull() for f in features], F.lit(True))
    return model.transform(frame).withColumn("prediction", F.when(known, F.col("prediction")))


def fit_linear(frame: DataFrame, features: Sequence[str], intercept: bool = True) -> PipelineModel:
    estimator = LinearRegression(labelCol=LABEL, solver="normal", fitIntercept=intercept)
    return Pipeline(stages=[_assembler(features), estimator]).fit(_complete(frame, features))


def fit_forest(
    frame: DataFrame,
    features: Sequence[str],
    num_trees: int,
    feature_subset: str = "all",
    min_leaf: int = 12,
    max_depth: int = MAX_DEPTH,
    seed: int = 0,
) -> PipelineModel:
    estimator = RandomForestRegressor(
        labelCol=LABEL,
        numTrees=num_trees,
        featureSubsetStrategy=feature_subset,
        minInstancesPerNode=min_leaf,
        maxDepth=max_depth,
        seed=seed,
    )
    return Pipeline(stages=[_assembler(features), estimator]).fit(_complete(frame, features))


def coefficient_table(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, coefficient, p_value)``: coefficients of the regression with intercept on the training rows,
    p-values of the one without intercept on all rows. Constant features have neither."""
    used = varying(frame, features)
    with_intercept = fit_linear(frame.where(F.col("split") == "train"), used).stages[-1]
    without = fit_linear(frame, used, intercept=False).stages[-1]
    found = {
        name: (float(c), float(p))
        for name, c, p in zip(used, with_intercept.coefficients, without.summary.pValues)
    }
    rows = [(name, *found.get(name, (None, None))) for name in features]
    return frame.sparkSession.createDataFrame(rows, "feature string, coefficient double, p_value double")
