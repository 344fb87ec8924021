"""The rule pipeline by increments: new files through both stages, with rules looked up per batch and a sequence number
that goes on from batch to batch.

A batch may run again after a failure. It then replaces its own folders, and its numbers start where they started
before: the row count up to each batch is committed once, under the batch's number, after its rows are written.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.text import quoted
from ledgerline.operators.shaping import apply_mapping, trim_strings
from ledgerline.plans import rules
from ledgerline.sources.commits import create_once, read_version, version_file, versions
from ledgerline.sources.sinks import write_batch
from ledgerline.streaming.incremental import new_files, run_to_end

SEQUENCE = "S.No"


@dataclass(frozen=True)
class Zones:
    """Folders of the pipeline: incoming files, the two zones, and its own progress."""

    incoming: str
    transformed: str
    published: str
    progress: str


Metadata = Callable[[], tuple[DataFrame, DataFrame, DataFrame]]


def high_water(spark: SparkSession, marks: str, batch_id: int) -> int:
    """Rows numbered before a batch: the mark of the last batch before it that had rows. Marks are numbered from 1."""
    before = [v for v in versions(spark, marks) if v <= batch_id]
    return read_version(spark, marks, before[-1])["high"] if before else 0


def with_offset(df: DataFrame, start: int, column: str = SEQUENCE) -> DataFrame:
    """``df`` with ``start`` added to its sequence number."""
    if column not in df.columns:
        return df
    shifted = (F.col(quoted(column)) + F.lit(start)).cast(df.schema[column].dataType)
    return df.select(*[shifted.alias(c) if c == column else F.col(quoted(c)) for c in df.columns])


def process_batch(
    batch: DataFrame, batch_id: int, load: str, source: str, mapping: StructType, zones: Zones, metadata: Metadata
) -> None:
    """One batch through both stages. The rules are those of the newest upload at this moment."""
    spark = batch.sparkSession
    log, lists, catalogue = metadata()
    place = f"load={load}/batch_id={batch_id}"
    stages = (rules.RAW_TO_TRANSFORMED, rules.TRANSFORMED_TO_PUBLISHED)
    names = rules.names_by_stage(log, lists, catalogue, stages) if source == "DS1" else {s: [] for s in stages}
    first = rules.apply_rules(trim_strings(apply_mapping(batch, mapping)), names[rules.RAW_TO_TRANSFORMED])
    transformed = write_batch(first, f"{zones.transformed}/{source}/{place}")
    marks = f"{zones.progress}/marks"
    start = high_water(spark, marks, batch_id)
    second = rules.apply_rules(trim_strings(transformed), names[rules.TRANSFORMED_TO_PUBLISHED])
    published = write_batch(with_offset(second, start), f"{zones.published}/{source}/{place}")
    mark = version_file(marks, batch_id + 1)
    if not create_once(spark, mark, json.dumps({"high": start + published.count(), "load": load})):
        known = read_version(spark, marks, batch_id + 1)["high"]
        if known != start + published.count():  # the batch ran before with other rows
            raise RuntimeError(f"batch {batch_id} had {known - start} rows when it was committed")


def load_through_rules(
    spark: SparkSession,
    source: str,
    schema: StructType,
    mapping: StructType,
    zones: Zones,
    metadata: Metadata,
    fmt: str = "csv",
    files_per_batch: int | None = None,
) -> None:
    """Files that arrived since the last run, batch by batch through both stages into Parquet zones.

    ``metadata`` gives the ingest log, the rule lists and the rule catalogue; it is asked once per batch. ``schema`` is that of the
    files, ``mapping`` the layout that the first stage keeps. Read the result with ``spark.read.parquet`` on
    ``<zone>/<source>``; ``load`` and ``batch_id`` come from the folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():  # asks the new files only
            session = batch.sparkSession
            load = session.read.json(f"{zones.progress}/stream/metadata").first()["id"]
            process_batch(batch, batch_id, load, source, mapping, zones, metadata)

    rows = new_files(spark, zones.incoming, schema, fmt, files_per_batch)
    run_to_end(rows.writeStream.foreachBatch(write), f"{zones.progress}/stream")
