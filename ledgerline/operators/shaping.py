"""Projections, casts, renames and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ledgerline.functions.text import quoted


def apply_mapping(
    df: DataFrame, mapping: T.StructType | Iterable[tuple[str, str, str]], allow_missing: bool = False
) -> DataFrame:
    """Keep exactly the mapped columns as ``(source, target, type)``; names match without case.

    A struct type maps every field to itself. Values that do not fit the type become null. With
    ``allow_missing`` an absent source column is a typed null, otherwise it is an error.
    """
    if isinstance(mapping, T.StructType):
        mapping = [(f.name, f.name, f.dataType.simpleString()) for f in mapping]
    present = {name.lower(): (name, dtype) for name, dtype in df.dtypes}
    out: list[str] = []
    for source, target, dtype in mapping:
        name, held = present.get(source.lower(), (None, None))
        if name is None and not allow_missing:
            raise ValueError(f"source column {source!r} is missing")
        value = "NULL" if name is None else quoted(name)
        out.append(f"{value if held == dtype else f'try_cast({value} AS {dtype})'} AS {quoted(target)}")
    return df.selectExpr(*out)


def trim_strings(df: DataFrame) -> DataFrame:
    """Outer spaces removed from every string column, in one projection."""
    names = [(quoted(f.name), isinstance(f.dataType, T.StringType)) for f in df.schema]
    return df.selectExpr(*[f"trim({name}) AS {name}" if is_text else name for name, is_text in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Names match without case; unknown names are ignored."""
    return df.drop(*names)


def drop_null(df: DataFrame, how: str | None = None, subset: Sequence[str] | None = None) -> DataFrame:
    """Without ``how`` all rows stay, as rule tables expect of this name; with it, incomplete rows go."""
    return df if how is None else df.na.drop(how=how, subset=list(subset) if subset else None)


def publish(df: DataFrame, layout: Sequence[tuple[str, str]]) -> DataFrame:
    """Select and rename to a published layout of ``(published name, source name)``."""
    return df.selectExpr(*[f"{quoted(source)} AS {quoted(target)}" for target, source in layout])


def first_rows(df: DataFrame, n: int, day: Column, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``day`` and then ``order_by``.

    Counting rows per day first (map-side combined, one row per calendar day) tells on which day row ``n``
    falls, so that only rows up to that day meet the final sort instead of ``n`` rows of every partition.
    """
    dated = df.withColumn("_day", day.cast("date"))
    per_day = dated.groupBy("_day").agg(F.count(F.lit(1)).alias("_rows"))
    days_in_order = Window.orderBy(F.col("_day").asc_nulls_last())
    before = F.coalesce(F.sum("_rows").over(days_in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    needed = per_day.withColumn("_before", before).where(F.col("_before") < n)
    last = needed.agg(
        F.struct(F.max("_day").alias("day"), F.coalesce(F.bool_or(F.col("_day").isNull()), F.lit(False)).alias("undated"))
    ).scalar()
    kept = dated.where((F.col("_day") <= last["day"]) | (F.col("_day").isNull() & last["undated"]))
    return kept.orderBy(F.col("_day").asc_nulls_last(), *order_by).limit(n).drop("_day")


def union_all(*parts: DataFrame) -> DataFrame:
    """Rows of all parts; columns are matched by name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
