"""Training runs: parameter grids, the run log and the choice of the best run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ledgerline.schemas import RUNS


def grid(**values: Sequence[Any]) -> list[dict[str, Any]]:
    return [dict(zip(values, combination)) for combination in product(*values.values())]


def run_record(
    job: str, model: str, params: Mapping[str, Any], metric: str, value: float, at: datetime, path: str | None = None
) -> tuple[Any, ...]:
    return job, model, {k: str(v) for k, v in params.items()}, metric, float(value), at, path


def run_grid(
    spark: SparkSession,
    model: str,
    metric: str,
    candidates: Sequence[Mapping[str, Any]],
    fit: Callable[..., PipelineModel],
    measure: Callable[[PipelineModel], float],
    parallelism: int = 4,
    folder: str | None = None,
) -> DataFrame:
    """Fit every candidate on Spark, some at a time, and return the run table.

    With a ``folder`` each model is saved below it by the thread that fitted it and forgotten; the run's ``path`` says
    where. So no more than ``parallelism`` models are in memory, and only the one that is wanted is loaded again.
    """

    def run(number: int) -> tuple[Any, ...]:
        job, params = f"{model}-{number:03d}", candidates[number]
        fitted = fit(**params)
        path = f"{folder}/{job}" if folder else None
        if path:
            fitted.write().overwrite().save(path)
        return run_record(job, model, params, metric, measure(fitted), datetime.now(), path)

    with ThreadPool(parallelism) as pool:
        records = pool.map(inheritable_thread_target(spark)(run), range(len(candidates)), chunksize=1)
    return spark.createDataFrame(records, RUNS)
