"""Readers for files from outside: headers are checked, and rows that do not fit are set aside instead of lost."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ledgerline.functions.text import quoted
from ledgerline.schemas import MACRO, RATES
from ledgerline.sources.files import CSV_OPTIONS

_RAW = "_raw_record"


@dataclass
class Checked:
    """``good`` has the columns asked for; ``bad`` the rows set aside: ``source_file, reason, record``."""

    good: DataFrame
    bad: DataFrame

    def quarantine(self, folder: str) -> int:
        """Add the rows set aside to a folder and return how many there were."""
        self.bad.withColumn("set_aside_at", F.current_timestamp()).write.mode("append").parquet(folder)
        return self.bad.count()


def read_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    required: Sequence[str] = (),
    positive: Sequence[str] = (),
    date_format: str = "yyyy-MM-dd",
    line_breaks: bool = False,
) -> Checked:
    """CSV files whose headers must be the columns of ``schema`` in their order; a file with another header is an error that
    names it, raised when the rows are read.

    A row is set aside if a field cannot be read as its type, if it has too many or too few fields, if a ``required``
    column is missing, or if a ``positive`` one is not above zero. Both frames come from one scan each; all columns are
    parsed in both, so that the same rows are good whatever is selected.
    """
    reader = spark.read.options(
        **CSV_OPTIONS,
        enforceSchema=False,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=_RAW,
        columnPruning=False,
        multiLine=line_breaks,
        dateFormat=date_format,
    )
    rows = reader.schema(StructType([*schema.fields]).add(_RAW, StringType())).csv(path)
    rows = rows.withColumn("source_file", F.col("_metadata.file_path"))
    checks = [(F.col(_RAW).isNotNull(), F.lit("unreadable"))]
    checks += [(F.col(quoted(c)).isNull(), F.lit(f"missing {c}")) for c in required]
    checks += [(F.col(quoted(c)) <= 0, F.lit(f"{c} not above zero")) for c in positive]
    reason = reduce(lambda rest, check: F.when(check[0], check[1]).otherwise(rest), reversed(checks), F.lit(None))
    judged = rows.withColumn("reason", reason)
    names = [F.col(quoted(c)) for c in schema.names]
    record = F.coalesce(F.col(_RAW), F.to_csv(F.struct(*names)))
    return Checked(
        judged.where(F.col("reason").isNull()).select(*names),
        judged.where(F.col("reason").isNotNull()).select("source_file", "reason", record.alias("record")),
    )


def read_rates(spark: SparkSession, path: str | Sequence[str]) -> Checked:
    """Exchange rates ``currency, rate_date, usd_rate``; a rate is needed and above zero."""
    return read_checked(spark, path, RATES, required=RATES.names, positive=["usd_rate"])


def read_macro(spark: SparkSession, path: str | Sequence[str]) -> Checked:
    """Macro series ``series, date, value``; an observation may be missing, its series and day may not."""
    return read_checked(spark, path, MACRO, required=["series", "date"])
