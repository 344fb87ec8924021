"""Global row numbers and quartile buckets without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import quoted
from ledgerline.session import remove, wide_writes, written, written_at

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def sequence_numbers(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    unique: bool = False,
    total: str | None = None,
    ties: str = "columns",
) -> DataFrame:
    """Row numbers 1..n over the whole frame in ``order_by`` order; ``total`` names a column for n.

    The rows are range-partitioned and sorted per partition, the position in the partition is taken from
    ``monotonically_increasing_id`` and the sizes of the earlier partitions are added. What is ranged is written
    to the shared folder, because both the sizes and the numbers must come from the same partitions; the sizes
    then need one column only.

    With ``unique`` the order columns identify a row. Otherwise ties are ordered by the other columns, or with
    ``ties="hash"`` by a hash of them, which keeps the sampled range keys of wide rows narrow; and exact copies, which
    no column can tell apart, by their place in the input. So one hot key or one large group of copies is still cut
    into several ranges. For that place to be the same whenever it is read, the input is written with it first. With
    ``ties="hash"`` it is written with the hash too, only the order columns are then ranged, sorted and written, and a row
    gets its number by its place: wide rows are shuffled once, by that place, and neither sampled nor written again.
    """
    keys = [quoted(k) for k in order_by]
    columns = [quoted(c) for c in df.columns]
    work, kept, place = df, columns, None
    by_place = not unique and ties == "hash"
    if not unique:
        taken = {k.lower() for k in order_by}
        others = [f.name for f in df.schema if f.name.lower() not in taken and not isinstance(f.dataType, T.MapType)]
        if by_place:
            work = work.withColumn("_ties", F.xxhash64(*map(quoted, others)) if others else F.lit(0))
            keys.append("_ties")
        else:
            keys += map(quoted, others)
        with wide_writes(df.sparkSession):
            work, place = written_at(work.withColumn("_copy", F.monotonically_increasing_id()), "numbering-input")
        keys.append("_copy")
        kept = ["_copy"] if by_place else columns
    ranged = written(
        work.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*kept, F.monotonically_increasing_id().alias("_at")),
        "numbering",
    )
    if place and not by_place:
        remove(df.sparkSession, place)
    part = F.shiftright("_at", _POSITION_BITS)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(everything).alias("_total"),
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbered = ranged.withColumn("_part", part).join(
        F.broadcast(starts), "_part"  # one row per shuffle partition
    )
    numbers = [(F.col("_start") + position + 1).alias(name), *([F.col("_total").alias(total)] if total else [])]
    if not by_place:
        return numbered.select(*kept, *numbers)
    added = [quoted(n) for n in (name, total) if n]
    return work.join(numbered.select("_copy", *numbers), "_copy").select(*columns, *added)


def quartile(rank: Column, n: Column) -> Column:
    """Equal-frequency quartile 1..4 of rank ``1..n``, right-closed on interpolated quantiles.

    Integer form of ``max(1, ceil(4 (rank - 1) / (n - 1)))``; a single row is in quartile 1.
    """
    steps = F.greatest(n - 1, F.lit(1))
    return F.greatest(F.lit(1), F.floor((4 * (rank - 1) + steps - 1) / steps)).cast("int")


def measure_quartiles(df: DataFrame, id_col: str, measures: Sequence[str]) -> DataFrame:
    """``<measure>_quartile`` for each measure; ties are ordered by the id, which must be unique.

    All measures are ranked in one range shuffle of narrow ``(measure, value, id)`` rows. A missing value has no
    quartile, and the others are ranked and counted without it.
    """
    entries = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("measure"), F.col(m).cast("double").alias("value"))
                for i, m in enumerate(measures)
            ]
        )
    )
    long = df.select(F.col(id_col), entries.alias("e")).select(id_col, "e.measure", "e.value")
    long = long.withColumn("unknown", F.col("value").isNull())
    numbered = sequence_numbers(long, ["measure", "unknown", "value", id_col], "_row", unique=True, total="_entries")
    # Every id has one entry per measure, so a measure's block starts after measure * ids rows.
    ids = F.floor(F.col("_entries") / len(measures))
    counts = long.groupBy("measure").agg(F.count("value").alias("_known"))
    numbered = numbered.join(F.broadcast(counts), "measure")  # one row per measure
    bucket = F.when(~F.col("unknown"), quartile(F.col("_row") - F.col("measure") * ids, F.col("_known")))
    return numbered.groupBy(id_col).agg(
        *[F.max(F.when(F.col("measure") == i, F.col("value"))).alias(m) for i, m in enumerate(measures)],
        *[F.max(F.when(F.col("measure") == i, bucket)).alias(f"{m}_quartile") for i, m in enumerate(measures)],
    )
