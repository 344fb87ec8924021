"""The ingest log: an append-only table of uploads and stamps, and choosing the job for the newest upload.

Rows are never changed. A stamp is a further row of the same upload with the published path and name; the state of an
upload is its row of the newest version. Each append is a few files of its own and one version file, so its cost does
not depend on the length of the log, and two writers at a time cannot undo each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ledgerline.schemas import INGEST_LOG
from ledgerline.session import remove
from ledgerline.sources.commits import commit, read_version, versions

_VERSION = "log_version"


def newest_log_row(log: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*log.columns), F.struct("upld_ts", "file_upld_log_id"))
    return log.agg(newest.alias("l")).where(F.col("l").isNotNull()).select("l.*")


def stamp_log(log: DataFrame, published: DataFrame) -> DataFrame:
    """The newest row of ``log`` with path and name of the published file (one row ``path, file_name``): one row, or none if
    the log or ``published`` is empty."""
    file = published.select(F.col("path").alias("_path"), F.col("file_name").alias("_name"))
    stamped = newest_log_row(log).crossJoin(file.limit(1))  # one row with one row
    values = {"published_file_path": F.col("_path"), "published_file_name": F.col("_name")}
    return stamped.select(*[values.get(c, F.col(c)).alias(c) for c in log.columns])


def _folders(folder: str) -> tuple[str, str]:
    return f"{folder}/rows", f"{folder}/versions"


def append_log(
    spark: SparkSession,
    folder: str,
    rows: Callable[[DataFrame], DataFrame] | DataFrame,
    schema: StructType = INGEST_LOG,
) -> int:
    """Add rows to the log and return the version that holds them.

    ``rows`` may be a function of the log as it is: it is asked again if another writer was faster, so that what it adds
    fits the log that it is added to. Rows of a lost attempt are removed.
    """
    data, marks = _folders(folder)
    while True:
        done = versions(spark, marks)
        seen = done[-1] if done else 0
        made = rows if isinstance(rows, DataFrame) else rows(read_log(spark, folder, seen, schema))
        part = uuid.uuid4().hex
        made.write.parquet(f"{data}/part={part}")

        def content(version: int) -> dict:
            return {"part": part, "after": seen}

        if isinstance(rows, DataFrame):  # these rows do not depend on the log: any next version will do
            return commit(spark, marks, content)
        try:
            return commit(spark, marks, lambda version: content(version) if version == seen + 1 else _lost())
        except _Lost:
            remove(spark, f"{data}/part={part}")


class _Lost(Exception):
    """Another writer was faster."""


def _lost():
    raise _Lost


def log_history(spark: SparkSession, folder: str, version: int | None = None, schema: StructType = INGEST_LOG) -> DataFrame:
    """Every row up to a version (the newest by default), with its ``log_version``. Uncommitted files are not read."""
    data, marks = _folders(folder)
    known = [v for v in versions(spark, marks) if version is None or v <= version]
    # One line per append of the log, in one small file each; their rows are read in one scan.
    parts = [(read_version(spark, marks, v)["part"], v) for v in known]
    full = StructType([*schema.fields]).add(_VERSION, LongType())
    if not parts:
        return spark.createDataFrame([], full)
    numbers = spark.createDataFrame(parts, f"_part string, {_VERSION} long")
    rows = spark.read.schema(schema).parquet(*[f"{data}/part={part}" for part, _ in parts])
    named = rows.withColumn("_part", F.regexp_extract(F.col("_metadata.file_path"), "/part=([0-9a-f]{32})/", 1))
    return named.join(F.broadcast(numbers), "_part").select(*full.names)  # one row per append, as listed above


def read_log(spark: SparkSession, folder: str, version: int | None = None, schema: StructType = INGEST_LOG) -> DataFrame:
    """The log as of a version, the newest by default: of each upload its last row."""
    history = log_history(spark, folder, version, schema)
    rest = [c for c in schema.names if c != "file_upld_log_id"]
    last = F.max_by(F.struct(*rest), _VERSION).alias("r")
    return history.groupBy("file_upld_log_id").agg(last).select("file_upld_log_id", "r.*").select(*schema.names)


def stamp_newest(spark: SparkSession, folder: str, published: DataFrame, schema: StructType = INGEST_LOG) -> int:
    """Stamp the newest upload with the published file: one row is written."""
    return append_log(spark, folder, lambda log: stamp_log(log, published), schema)
