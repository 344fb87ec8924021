"""Incremental zone loads: each file is taken up once, also over restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter
from pyspark.sql.types import StructType

from ledgerline.sources.files import CSV_OPTIONS

NO_AGE_LIMIT = "36500d"


def new_files(spark: SparkSession, folder: str, schema: StructType, fmt: str, files_per_batch: int | None) -> DataFrame:
    # Spark ignores files much older than the newest one unless told otherwise; a late file is still a new file.
    reader: DataStreamReader = spark.readStream.schema(schema).format(fmt).option("maxFileAge", NO_AGE_LIMIT)
    if fmt == "csv":  # as the zones are written: quotes inside a text are doubled, texts may hold line breaks
        reader = reader.options(**CSV_OPTIONS, multiLine=True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_to_end(writer: DataStreamWriter, progress: str) -> None:
    query = writer.option("checkpointLocation", progress).trigger(availableNow=True).start()
    query.awaitTermination()


def load_new_rows(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    target: str,
    progress: str,
    transform: Callable[[DataFrame], DataFrame],
    fmt: str = "csv",
    files_per_batch: int | None = None,
) -> None:
    """Files that arrived since the last run, through a row-wise ``transform`` into a Parquet folder.

    The file sink's own commit log makes the result exactly-once; read it with ``spark.read.parquet(target)``.
    """
    rows = new_files(spark, folder, schema, fmt, files_per_batch).transform(transform)
    run_to_end(rows.writeStream.format("parquet").option("path", target), progress)


def load_new_batches(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    target: str,
    progress: str,
    transform: Callable[[DataFrame], DataFrame],
    fmt: str = "csv",
    files_per_batch: int | None = None,
) -> None:
    """As ``load_new_rows`` for rules that need a whole batch, such as numbering.

    A batch may run again after a failure, so each one replaces its own folder ``load=<id>/batch_id=<n>``. The id is
    the one Spark keeps in ``progress``: a run with another progress folder adds to the target and replaces nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            load = batch.sparkSession.read.json(f"{progress}/metadata").first()["id"]
            transform(batch).write.mode("overwrite").parquet(f"{target}/load={load}/batch_id={batch_id}")

    rows = new_files(spark, folder, schema, fmt, files_per_batch)
    run_to_end(rows.writeStream.foreachBatch(write), progress)
