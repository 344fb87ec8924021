"""Rule registry, rule lookup in the metadata tables and the two loading stages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import list_items
from ledgerline.operators.order_model import order_model
from ledgerline.operators.shaping import drop_null, trim_strings
from ledgerline.sources.jdbc import Database, append_table
from ledgerline.sources.sinks import write_zone

RAW_TO_TRANSFORMED = "raw_to_transformed_rules"
TRANSFORMED_TO_PUBLISHED = "transformed_to_published_rules"

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Target:
    """Where a stage writes: a zone folder, and a database and table for the database writers."""

    zone: str
    database: Database | None = None
    table: str | None = None


Writer = Callable[[DataFrame, Target, str], None]

TRANSFORMS: dict[str, Transform] = {}
WRITERS: dict[str, Writer] = {}


def rule(name: str) -> Callable[[Transform], Transform]:
    """Register a transformation under the name the rule tables use."""

    def register(function: Transform) -> Transform:
        TRANSFORMS[name] = function
        return function

    return register


def writer(name: str) -> Callable[[Writer], Writer]:
    def register(function: Writer) -> Writer:
        WRITERS[name] = function
        return function

    return register


rule("dropNull")(drop_null)
rule("customModel")(order_model)
rule("getTrimmedDataframe")(trim_strings)


def _zone_writer(fmt: str) -> Writer:
    return lambda df, target, source: write_zone(df, target.zone, source, fmt)


def _database_writer(df: DataFrame, target: Target, source: str) -> None:
    if target.database is None or not target.table:
        raise ValueError("a database writer needs a database and a table")
    append_table(df, target.database, target.table)


for _name, _function in {
    "writeDataIntoTransformedZoneInParquet": _zone_writer("parquet"),
    "writeDataIntoTransformedZoneInCSV": _zone_writer("csv"),
    "writeDataIntoPublishedS3ZoneInParquet": _zone_writer("parquet"),
    "writeDataIntoPublishedS3ZoneInCSV": _zone_writer("csv"),
    "writeTransformedDataIntoRDS": _database_writer,
    "writePublishedDataIntoRDS": _database_writer,
}.items():
    writer(_name)(_function)


def latest_upload(log: DataFrame) -> DataFrame:
    """Source and upload type of the newest log row; the larger log id wins a tie."""
    newest = F.max_by(F.struct("file_src_cd", "file_upld_type"), F.struct("upld_ts", "file_upld_log_id"))
    return log.agg(newest.alias("u")).where(F.col("u").isNotNull()).select("u.*")


def rule_entries(rule_lists: DataFrame, stage: str) -> DataFrame:
    """One row per entry of the comma lists: ``(file_src_cd, file_upld_type, position, entry)``."""
    return rule_lists.select(
        "file_src_cd", "file_upld_type", F.posexplode(list_items(F.col(stage))).alias("position", "entry")
    ).where(F.col("entry") != "")


def resolve_rules(log: DataFrame, rule_lists: DataFrame, rules: DataFrame, stage: str) -> DataFrame:
    """``(position, rule_id, rule_dscrp)`` of the rules that apply to the newest upload, in list order.

    An entry that occurs twice counts once, at its first place; entries without a rule have no effect.
    """
    of_upload = rule_lists.join(latest_upload(log), ["file_src_cd", "file_upld_type"], "left_semi")
    return name_entries(of_upload, rules, stage).select("position", "rule_id", "rule_dscrp")


def names_by_stage(
    log: DataFrame, rule_lists: DataFrame, rules: DataFrame, stages: Sequence[str]
) -> dict[str, list[str]]:
    """Rule names of the newest upload in application order, for several stages: the log is asked once, and its one row
    picks the lists."""
    newest = latest_upload(log).first()
    if newest is None:
        return {stage: [] for stage in stages}
    of_upload = rule_lists.where(
        (F.col("file_src_cd") == F.lit(newest.file_src_cd)) & (F.col("file_upld_type") == F.lit(newest.file_upld_type))
    )
    return {stage: rule_names(name_entries(of_upload, rules, stage)) for stage in stages}


def name_entries(rule_lists: DataFrame, rules: DataFrame, stage: str) -> DataFrame:
    """The rules of every listed source and upload type, with their place in the list."""
    entries = (
        rule_entries(rule_lists, stage)
        .groupBy("file_src_cd", "file_upld_type", "entry")
        .agg(F.min("position").alias("position"))
    )
    catalogue = rules.withColumn("entry", F.col("rule_id").cast("string"))
    return entries.join(catalogue, "entry").drop("entry")


def rule_names(resolved: DataFrame) -> list[str]:
    """Names in application order; their number is bounded by one list in the metadata."""
    return [r.rule_dscrp for r in resolved.orderBy("position").select("rule_dscrp").toLocalIterator()]


def split_names(names: Sequence[str]) -> tuple[list[str], list[str]]:
    """Transformations and writers, each in their order. Unknown names are an error."""
    writers = [n for n in names if n.startswith("write")]
    transforms = [n for n in names if not n.startswith("write")]
    unknown = [n for n in writers if n not in WRITERS] + [n for n in transforms if n not in TRANSFORMS]
    if unknown:
        raise ValueError(f"unknown rules: {unknown}")
    return transforms, writers


def apply_rules(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named transformations in order; writers among the names are left out."""
    transforms, _ = split_names(names)
    return reduce(lambda frame, name: frame.transform(TRANSFORMS[name]), transforms, df)


# Writer per (stage, source) where the rules name none. Source DS2 is not rule-driven.
DEFAULT_WRITERS = {
    (RAW_TO_TRANSFORMED, "DS1"): "writeDataIntoTransformedZoneInCSV",
    (RAW_TO_TRANSFORMED, "DS2"): "writeDataIntoTransformedZoneInParquet",
    (TRANSFORMED_TO_PUBLISHED, "DS1"): "writeDataIntoPublishedS3ZoneInCSV",
    (TRANSFORMED_TO_PUBLISHED, "DS2"): "writeDataIntoPublishedS3ZoneInCSV",
}


def run_stage(df: DataFrame, stage: str, source: str, target: Target, names: Sequence[str] = ()) -> DataFrame:
    """Trim, apply the rules, then run the writers; returns the frame that was written.

    All transformations run before the first writer, wherever the writers stand in the list. With several
    writers the rows are kept between them.
    """
    if (stage, source) not in DEFAULT_WRITERS:
        raise ValueError(f"no stage {stage!r} for source {source!r}")
    names = list(names) if source == "DS1" else []
    _, writers = split_names(names)
    out = apply_rules(trim_strings(df), names)
    writers = writers or [DEFAULT_WRITERS[stage, source]]
    if len(writers) > 1:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name in writers:
            WRITERS[name](out, target, source)
    finally:
        if len(writers) > 1:
            out.unpersist()
    return out
