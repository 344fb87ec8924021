"""Zone and result writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import wide_writes

PARTITION_COLUMN = "file_type"
UPLOAD_COLUMN = "upload_id"
# Quotes inside a text are doubled and outer blanks kept; the readers' CSV_OPTIONS match.
CSV_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_zone(
    df: DataFrame, zone: str, source: str, fmt: str, single_file: bool = False, max_rows_per_file: int = 5_000_000,
    upload_id: str | None = None,
) -> None:
    """Append to ``<zone>/<source>/file_type=<value>/``, or with an ``upload_id`` to its folder ``upload_id=<id>/``
    there, which keeps the rows of one upload together however many files they fill.

    Every task writes its own files: the upload classes are few and one of them may hold most rows, so the rows
    are not brought together per class. ``single_file`` makes one task write one file per class, for readers that
    want a single extract; zones are read as folders and do not need it.
    """
    if single_file:
        df, max_rows_per_file = df.coalesce(1), 0
    folders = [PARTITION_COLUMN]
    if upload_id is not None:
        df, folders = df.withColumn(UPLOAD_COLUMN, F.lit(upload_id)), [*folders, UPLOAD_COLUMN]
    writer = df.write.mode("append").partitionBy(*folders).option("maxRecordsPerFile", max_rows_per_file)
    path = f"{zone}/{source}"
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown zone format {fmt!r}")
    with wide_writes(df.sparkSession):  # the upload classes are few
        if fmt == "csv":
            writer.options(**CSV_WRITE).csv(path)
        else:
            writer.parquet(path)


def write_batch(df: DataFrame, path: str) -> DataFrame:
    """A batch's own folder, replaced as a whole if the batch runs again; returns its rows as written."""
    with wide_writes(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_result(df: DataFrame, folder: str, name: str, fmt: str = "parquet") -> str:
    """An analytic result table, replaced as a whole; returns its path."""
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path
