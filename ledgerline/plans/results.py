"""Results of a job, published as a whole.

A job writes its tables, its run rows and its models below a folder of its own attempt and then commits one version
file that names them. Readers follow version files only, so they see all tables of a run or none of it, and an attempt
that failed half-way leaves nothing that anyone reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.stats import best_run
from ledgerline.schemas import RUNS
from ledgerline.sources.commits import commit, read_version, versions
from ledgerline.sources.sinks import write_result

RUN_TABLE = "runs"


def _marks(folder: str, job: str) -> str:
    return f"{folder}/{job}/versions"


def attempt_folder(folder: str, job: str) -> str:
    """A fresh place for the tables and models of one attempt."""
    return f"{folder}/{job}/attempts/{uuid.uuid4().hex}"


def publish_results(
    spark: SparkSession, folder: str, job: str, tables: Mapping[str, DataFrame], place: str | None = None
) -> int:
    """Write all tables and commit them together; returns the version. ``runs``, if among them, is the attempt's run table,
    whose ``path`` names the models that were saved below ``place``. A table is stored once, as Parquet."""
    place = place or attempt_folder(folder, job)
    for name, table in tables.items():
        write_result(table, place, name)
    written = {"place": place, "tables": sorted(tables), "at": datetime.now(timezone.utc).isoformat()}
    return commit(spark, _marks(folder, job), lambda version: {**written, "version": version})


def result_versions(spark: SparkSession, folder: str, job: str) -> list[int]:
    return versions(spark, _marks(folder, job))


def read_result(spark: SparkSession, folder: str, job: str, name: str, version: int | None = None) -> DataFrame:
    """A table of a committed version, the newest by default."""
    known = result_versions(spark, folder, job)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no committed version {version or ''} of {job}".replace("  ", " "))
    mark = read_version(spark, _marks(folder, job), version or known[-1])
    if name not in mark["tables"]:
        raise ValueError(f"version {mark['version']} of {job} has no table {name!r}, only {mark['tables']}")
    return spark.read.parquet(f"{mark['place']}/{name}")


def committed_runs(spark: SparkSession, folder: str, job: str) -> DataFrame:
    """The run rows of all committed versions, with their ``version``."""
    found = []
    for version in result_versions(spark, folder, job):
        mark = read_version(spark, _marks(folder, job), version)
        if RUN_TABLE in mark["tables"]:
            rows = spark.read.schema(RUNS).parquet(f"{mark['place']}/{RUN_TABLE}")
            found.append(rows.withColumn("version", F.lit(version).cast("long")))
    if not found:
        return spark.createDataFrame([], RUNS).withColumn("version", F.lit(None).cast("long"))
    return reduce(DataFrame.unionByName, found)


def best_model(spark: SparkSession, folder: str, job: str, metric: str, largest: bool) -> PipelineModel:
    """The model of the best run of all committed versions; no other model is read."""
    runs = committed_runs(spark, folder, job).where(F.col("path").isNotNull())
    best = best_run(runs, metric, largest).first()
    if best is None:
        raise ValueError(f"no committed run of {job} has a model and {metric}")
    return PipelineModel.load(best["path"])
