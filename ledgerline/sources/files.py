"""Readers for zones, published files and metric files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.text import file_name, quoted, upload_type
from ledgerline.schemas import METRIC_FILE


# Quotes inside a text are doubled; zones are written the same way. CSV as the sources write it does not tell an empty
# text from a null: both are read as null. Parquet zones keep the difference.
CSV_OPTIONS = {"header": True, "escape": '"'}


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, line_breaks: bool = True
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the data an extra time; a schema is
    matched to the columns by position. Texts may hold line breaks, as the zones' do; each file is then read by one
    task, and zone files have a bounded number of rows. Without ``line_breaks`` large files are split."""
    reader = spark.read.options(**CSV_OPTIONS, multiLine=line_breaks)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet_zone(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Parquet zone whose files may have gained columns over time."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_zone(
    spark: SparkSession, zone: str, source: str, fmt: str, schema: StructType | None = None
) -> DataFrame:
    """Read back ``<zone>/<source>``; ``file_type`` comes from the partition folders."""
    path = f"{zone}/{source}"
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "parquet":
        return read_parquet_zone(spark, path)
    raise ValueError(f"unknown zone format {fmt!r}")


def read_catalog_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")


def register_zone(
    spark: SparkSession, database: str, name: str, path: str, schema: StructType, partitions: Sequence[str]
) -> None:
    """A catalog table over a Parquet zone: its partitions are recovered from the folders, and its statistics taken, so that
    the planner knows sizes and reads only the partitions that a query asks for. Registering again takes in
    partitions that were added since."""
    table = f"`{database}`.{quoted(name)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if not spark.catalog.tableExists(f"{database}.{name}"):
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(map(quoted, partitions))
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def has_rows(df: DataFrame) -> bool:
    """True if there is at least one row; stops at the first one instead of counting."""
    return not df.isEmpty()


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``(path, modified, bytes, file_name, upload_type)`` of the data files below a folder, whatever their names;
    names that begin with ``_`` or ``.`` are not data. The file listing is a source of its own here: no file content is read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(root)
    )
    path = F.col("path")
    return listing.select(
        path,
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
        file_name(path).alias("file_name"),
        upload_type(path).alias("upload_type"),
    )


def latest_file(files: DataFrame) -> DataFrame:
    """The most recently modified file, as one row; the larger path wins a tie."""
    newest = F.max_by(F.struct(*files.columns), F.struct("modified", "path"))
    return files.agg(newest.alias("f")).where(F.col("f").isNotNull()).select("f.*")


def with_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Every row with the file it came from, so that one scan serves all files of a folder."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def read_metric_files(spark: SparkSession, folder: str) -> DataFrame:
    """All one-row metric files ``(job, metric value)`` of a folder as one table."""
    return read_csv(spark, folder, METRIC_FILE)
