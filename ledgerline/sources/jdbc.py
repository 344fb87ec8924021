"""Relational tables through Spark's own JDBC source and sink. Connection settings come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    properties: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.url or not self.driver:
            raise ValueError("a database needs a url and a driver")

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties}


def read_table(
    spark: SparkSession,
    database: Database,
    name: str,
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A whole table, read in parallel by ranges of ``split_column`` or by explicit predicates.

    Filters and column selections on the result are pushed to the database by Spark.
    """
    if predicates:
        properties = {"driver": database.driver, **database.properties}
        return spark.read.jdbc(database.url, name, predicates=list(predicates), properties=properties)
    options = {**database.options(), "dbtable": name}
    if split_column:
        if not bounds or not partitions:
            raise ValueError("a split column needs bounds and a number of partitions")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def read_query(spark: SparkSession, database: Database, query: str) -> DataFrame:
    """Result of a query evaluated in the database, such as a rule lookup. Errors are raised."""
    return spark.read.format("jdbc").options(**database.options()).option("query", query).load()


def append_table(df: DataFrame, database: Database, name: str, partitions: int = 16, batch_size: int = 10_000) -> None:
    """Append rows to a table over at most ``partitions`` connections.

    Each task writes in one transaction, so a failed task leaves nothing behind. A task that is repeated after
    its commit would add its rows again; give the table a unique key or load a staging table where that matters.
    """
    (
        df.write.format("jdbc")
        .options(**database.options())
        .option("dbtable", name)
        .option("numPartitions", partitions)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
