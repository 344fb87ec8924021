"""A small feed-forward network for 0/1 targets: rectified hidden units, one sigmoid unit, cross entropy and Adam.

A step's gradient is a sum over the rows of a batch: every task sums its own rows and sends one row per weight, Spark
adds these up, and the driver moves the weights, whose number depends on the layers only. Batches are parts of the
rows by a hash of their id, so a step reads a part of the files and any number of rows can take part in it. Scoring is
column arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.models.churn import feature_stages, inputs_of
from ledgerline.operators.stats import confusion_matrix
from ledgerline.schemas import CHURN_TARGET
from ledgerline.session import scratch_path

HIDDEN = (6, 6)


def shapes(inputs: int, hidden: Sequence[int] = HIDDEN) -> list[tuple[int, int]]:
    sizes = [inputs, *hidden, 1]
    return list(zip(sizes, sizes[1:]))


def layers(weights: np.ndarray, sizes: Sequence[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix and constants of each layer, from all weights in one row."""
    out, at = [], 0
    for rows, columns in sizes:
        out.append((weights[at : at + rows * columns].reshape(rows, columns), weights[at + rows * columns :][:columns]))
        at += (rows + 1) * columns
    return out


def gradient(weights: np.ndarray, sizes: Sequence[tuple[int, int]], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """The gradient of the summed cross entropy over some rows, and that sum."""
    parts = layers(weights, sizes)
    inputs = [x]
    for matrix, constants in parts[:-1]:
        inputs.append(np.maximum(inputs[-1] @ matrix + constants, 0))
    z = (inputs[-1] @ parts[-1][0] + parts[-1][1])[:, 0]
    loss = float((np.logaddexp(0, z) - y * z).sum())
    back = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)[:, None]
    found = []
    for (matrix, _), into in zip(reversed(parts), reversed(inputs)):
        found.append(np.concatenate([(into.T @ back).ravel(), back.sum(axis=0)]))
        back = (back @ matrix.T) * (into > 0)
    return np.concatenate(found[::-1]), loss


def summed_gradient(rows: DataFrame, weights: np.ndarray, sizes: Sequence[tuple[int, int]]) -> tuple[np.ndarray, float, int]:
    """As :func:`gradient` over all rows of a frame ``x`` (array), ``y``, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights) + 2)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                slope, loss = gradient(weights, sizes, x, y)
                total += np.concatenate([slope, [loss, batch.num_rows]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "v"])

    summed = rows.select("x", "y").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    found = np.zeros(len(weights) + 2)
    for row in summed.collect():  # one row per weight
        found[row["at"]] = row["v"]
    return found[:-2], float(found[-2]), int(found[-1])


@dataclass
class Network:
    """Encoders and scaler as a fitted pipeline, the weights, and the mean cross entropy of each epoch."""

    encoder: PipelineModel
    weights: np.ndarray
    sizes: list[tuple[int, int]]
    losses: list[float]

    def save(self, path: str) -> None:
        self.encoder.write().overwrite().save(f"{path}/encoder")
        spark = SparkSession.getActiveSession()
        row = (self.weights.tolist(), [list(s) for s in self.sizes], self.losses)
        frame = spark.createDataFrame([row], "weights array<double>, sizes array<array<int>>, losses array<double>")
        frame.write.mode("overwrite").parquet(f"{path}/weights")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Network:
        row = spark.read.parquet(f"{path}/weights").first()
        return cls(PipelineModel.load(f"{path}/encoder"), np.array(row["weights"]), [tuple(s) for s in row["sizes"]], row["losses"])

    def score(self, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
        """Every row with ``probability_exit`` and ``predicted``."""
        scored = self.encoder.transform(rows).withColumn("_x", vector_to_array("features"))
        parts, names = layers(self.weights, self.sizes), [F.col("_x")[i] for i in range(self.sizes[0][0])]
        dropped = ["_x"]
        for number, (matrix, constants) in enumerate(parts):
            last = number == len(parts) - 1
            made = {f"_h{number}_{k}": _unit(names, matrix[:, k], constants[k], last) for k in range(matrix.shape[1])}
            scored, names = scored.withColumns(made), [F.col(c) for c in made]
            dropped += made
        scored = scored.withColumn("probability_exit", 1 / (1 + F.exp(-names[0])))
        return scored.withColumn("predicted", (F.col("probability_exit") > threshold).cast("int")).drop(*dropped)


def _unit(inputs: Sequence[Column], weights: np.ndarray, constant: float, last: bool) -> Column:
    total = F.lit(float(constant))
    for column, weight in zip(inputs, weights):
        total = total + column * F.lit(float(weight))
    return total if last else F.greatest(total, F.lit(0.0))


def fit_network(
    train: DataFrame,
    id_col: str = "customerid",
    epochs: int = 20,
    batches: int = 4,
    rate: float = 0.05,
    seed: int = 0,
    hidden: Sequence[int] = HIDDEN,
) -> Network:
    """Train on all rows whose target is known; ``batches`` steps an epoch."""
    stages = feature_stages(train)
    encoder = Pipeline(stages=stages).fit(train)
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(batches)).cast("int")
    path = scratch_path(train.sparkSession, "network-rows")
    encoded = encoder.transform(train.where(F.col(CHURN_TARGET).isNotNull())).select(
        vector_to_array("features").alias("x"), F.col(CHURN_TARGET).cast("double").alias("y"), part.alias("part")
    )
    encoded.write.partitionBy("part").parquet(path)
    rows = train.sparkSession.read.schema("x array<double>, y double, part int").parquet(path)
    sizes = shapes(inputs_of(stages), hidden)
    rng = np.random.default_rng(seed)
    weights = np.concatenate(
        [np.append(rng.uniform(-1, 1, a * b) * np.sqrt(6 / (a + b)), np.zeros(b)) for a, b in sizes]
    )
    first, second, step, losses = np.zeros_like(weights), np.zeros_like(weights), 0, []
    for _ in range(epochs):
        loss = seen = 0
        for k in range(batches):
            slope, part_loss, n = summed_gradient(rows.where(F.col("part") == k), weights, sizes)
            if not n:
                continue
            step, loss, seen = step + 1, loss + part_loss, seen + n
            first = 0.9 * first + 0.1 * slope / n
            second = 0.999 * second + 0.001 * (slope / n) ** 2
            weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-7)
        losses.append(loss / max(seen, 1))
    return Network(encoder, weights, sizes, losses)


def accuracy(network: Network, rows: DataFrame) -> float:
    return confusion_matrix(network.score(rows), CHURN_TARGET, "predicted").first()["accuracy"]
