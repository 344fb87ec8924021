"""Customer churn classification."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import (
    ElementwiseProduct,
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import CHURN_FEATURES, CHURN_TARGET

def stable_split(df: DataFrame, id_col: str, percent: int = 80, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the id, so a row keeps its side whatever the partitioning."""
    in_train = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(100)) < percent
    return df.where(in_train), df.where(~in_train)


def feature_stages(train: DataFrame) -> list:
    """Gender as 0/1, geography as indicators without the alphabetically first level, all inputs standardised with
    the population deviation (Spark divides by the sample deviation, hence the factor).

    No row is dropped: a geography that training did not know has no indicator set, a missing number counts as the
    training mean, and a missing gender is a level of its own. The number of levels comes from the training rows.
    """
    numeric = [c for c in CHURN_FEATURES if c not in ("geography", "gender")]
    known = train.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("geography").alias("levels")).first()
    rows, flags = known["n"], max(known["levels"] - 1, 0)
    factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    # Descending order puts the alphabetically first level last; "keep" adds a level for unknown ones behind it, which
    # the encoder leaves out, and the slice leaves out the first level's indicator.
    order = {"geography": "alphabetDesc", "gender": "alphabetAsc"}
    slices = [VectorSlicer(inputCol="geography_levels", outputCol="geography_flags", indices=list(range(flags)))] if flags else []
    inputs = [*(["geography_flags"] if flags else []), "gender_index", *[f"{c}_known" for c in numeric]]
    return [
        *[
            StringIndexer(inputCol=c, outputCol=f"{c}_index", stringOrderType=kind, handleInvalid="keep")
            for c, kind in order.items()
        ],
        OneHotEncoder(inputCol="geography_index", outputCol="geography_levels", dropLast=True),
        *slices,
        SQLTransformer(
            statement=f"SELECT *, {', '.join(f'CAST({c} AS DOUBLE) AS {c}_value' for c in numeric)} FROM __THIS__"
        ),
        Imputer(inputCols=[f"{c}_value" for c in numeric], outputCols=[f"{c}_known" for c in numeric]),
        VectorAssembler(inputCols=inputs, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="unit_features", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="unit_features",
            outputCol="features",
            scalingVec=Vectors.dense([factor] * (flags + 1 + len(numeric))),
        ),
    ]


def inputs_of(stages: list) -> int:
    """Width of the inputs that the stages make."""
    return len(stages[-1].getScalingVec())


def fit_network(train: DataFrame, block_size: int = 10, max_iter: int = 20, seed: int = 0) -> PipelineModel:
    """Feed-forward network with two hidden layers of six. Its activations and optimiser are Spark's."""
    stages = feature_stages(train)
    network = MultilayerPerceptronClassifier(
        labelCol=CHURN_TARGET, layers=[inputs_of(stages), 6, 6, 2], blockSize=block_size, maxIter=max_iter, seed=seed
    )
    return Pipeline(stages=[*stages, network]).fit(train)


def fit_logistic(train: DataFrame) -> PipelineModel:
    model = LogisticRegression(labelCol=CHURN_TARGET)
    return Pipeline(stages=[*feature_stages(train), model]).fit(train)


def score(model: PipelineModel, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every row with the probability of leaving and the 0/1 prediction; encoders and scaler are the fitted ones."""
    return (
        model.transform(rows)
        .withColumn("probability_exit", vector_to_array("probability")[1])
        .withColumn("predicted", (F.col("probability_exit") > threshold).cast("int"))
    )
