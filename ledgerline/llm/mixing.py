"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

Each source gets as many slots of ``block`` words as its target needs. The slots of all sources lie on one line, source
after source, and the van der Corput points k = 0, 1, 2, ... are mapped through these cumulative weights: slot k of
the mix belongs to the source in whose stretch point k falls, so every stretch of the mix has the sources in their
proportions. A slot's rank within its source names a block of words of the source's documents, which are laid on a line
of their own in the order of a hash; a source that is taken more than once starts again from its beginning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted
from ledgerline.llm.common import Scratch
from ledgerline.operators.numbering import sequence_numbers

WORD = r"[^\x20\x09-\x0D]+"
_GROUP = 4096  # rows that one window of documents or slots holds, about


def running_start(df: DataFrame, number: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows with a smaller ``number`` (1..n): first within groups of
    consecutive numbers, then over the groups, of which there are n / 4,096."""
    group = F.floor((F.col(number) - 1) / _GROUP)
    grouped = df.withColumn("_group", group)
    sums = grouped.groupBy("_group").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_group", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_group").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(value).over(within), F.lit(0))
    return grouped.withColumn("_here", here).join(starts, "_group").select(
        *map(quoted, df.columns), (F.col("_start") + F.col("_here")).cast("long").alias(name)
    )


def source_targets(
    sized: DataFrame, weights: Sequence[float], share: float, most: int, block: int, scratch: Scratch
) -> DataFrame:
    """One row per source: ``source_no`` (by code point, null last), ``source_size``, ``target``, ``words`` (the target
    as a whole number) and ``slots``.

    The targets are ``min(most * size, level * weight)``; the level that brings their sum to ``share`` of all words is
    found by giving what is above a limit to the others again until nothing is. Each step is one aggregation to one row.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumn("absent", F.col("source").isNull())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    numbered = sequence_numbers(sizes, ["absent", "source"], "source_no", unique=True).select(
        "source",
        "source_no",
        "source_size",
        F.element_at(cycle, ((F.col("source_no") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).cast("long").alias("limit"),
    )
    rows = scratch.table(numbered)
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("limit") < F.lit(level) * F.col("weight")
        found = rows.agg(
            F.count_if(full), F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if found[0] == capped or not found[2]:
            break
        capped, level = found[0], (total - (found[1] or 0)) / found[2]
    target = F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight"))
    words = F.floor(target + 0.5).cast("long")
    return scratch.table(
        rows.select("source", "source_no", "source_size", target.alias("target"), words.alias("words"))
        .withColumn("slots", F.ceil(F.col("words") / block).cast("long"))
    )


def bit_reversed(number: Column, bits: int) -> Column:
    """The last ``bits`` bits of a number in reverse order: its van der Corput point times ``2 ** bits``."""
    for width, mask in (
        (1, 0x5555555555555555),
        (2, 0x3333333333333333),
        (4, 0x0F0F0F0F0F0F0F0F),
        (8, 0x00FF00FF00FF00FF),
        (16, 0x0000FFFF0000FFFF),
        (32, 0x00000000FFFFFFFF),
    ):
        high = F.shiftrightunsigned(number, width).bitwiseAND(F.lit(mask))
        number = high.bitwiseOR(F.shiftleft(number.bitwiseAND(F.lit(mask)), width))
    return F.shiftrightunsigned(number, 64 - bits)


def schedule(spark: SparkSession, sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``slot, source_no, rank``: the slots of the mix in order, and each one's rank among its source's slots.

    Points beyond the last slot are left out, so a source has exactly its number of slots. Points meet the sources'
    stretches by a coarse cell of the line, and ranks are counted within (source, 4,096 slots) and added up, so a
    source with most of the slots is ranked by many tasks.
    """
    placed = running_start(sources.select("source_no", "slots"), "source_no", "slots", "low")
    placed = scratch.table(placed.filter("slots > 0").withColumn("high", F.col("low") + F.col("slots")))
    slots, n = placed.agg(F.max("high"), F.count(F.lit(1))).first()
    slots = slots or 0
    bits = max(1, (slots - 1).bit_length()) if slots else 1
    cell = max(1, -(-slots // max(1024, 4 * n)))
    cells = F.explode(F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell)))
    stretches = placed.select("source_no", "low", "high", cells.alias("cell"))
    points = (
        spark.range(2**bits if slots else 0)
        .select(F.col("id").alias("slot"), bit_reversed(F.col("id"), bits).alias("point"))
        .filter(F.col("point") < slots)
        .withColumn("cell", F.floor(F.col("point") / cell))
    )
    found = points.join(stretches, "cell").filter("point >= low and point < high")
    found = scratch.table(
        found.select("slot", "source_no", F.floor(F.col("slot") / _GROUP).alias("part"))
    )
    counts = found.groupBy("source_no", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_no", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("source_no", "part").orderBy("slot")
    return found.withColumn("place", F.row_number().over(within)).join(starts, ["source_no", "part"]).select(
        "slot", "source_no", (F.col("start") + F.col("place") - 1).cast("long").alias("rank")
    )


def laid_out(sized: DataFrame, sources: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """Every document with its source's numbers and ``start``, its place on the source's line of words.

    Documents are ordered by a digest of seed and id, then id and size. Rows equal in id, source and size are counted
    first and written out again at the end. A source's line is summed per stretch of digests, about 4,096 rows each,
    so the largest source is laid out by as many tasks as it has such stretches.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    grouped = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    cuts = max(1, sized.count() // _GROUP)
    leading = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    rows = scratch.table(
        grouped.withColumn("digest", digest)
        .withColumn("stretch", F.shiftrightunsigned(leading * cuts, 32))
        .withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    )
    sums = rows.groupBy("key", "stretch").agg(F.sum(F.col("size") * F.col("copies")).alias("n"))
    before = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    known = sources.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    starts = sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").join(known, "key")
    within = Window.partitionBy("key", "stretch").orderBy("digest", "doc_id", "size")
    running = F.sum(F.col("size") * F.col("copies")).over(within.rowsBetween(Window.unboundedPreceding, -1))
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    return (
        rows.withColumn("running", F.coalesce(running, F.lit(0)))
        .join(starts, ["key", "stretch"])
        .select("*", copy.alias("copy"))
        .select(
            "doc_id",
            "source",
            "size",
            "source_no",
            "source_size",
            "target",
            "words",
            (F.col("before") + F.col("running") + F.col("copy") * F.col("size")).cast("long").alias("start"),
        )
    )


@dataclass
class Mix:
    """``documents``: every input row with ``size``, its source's numbers and its place. ``spans``: what the mix takes, by
    ``slot``: ``at`` (place in the slot), ``doc_id``, ``first_word`` and ``n_words`` of the document, ``round`` (0 for the
    first time), and ``source_no`` and ``start``, which name the row of ``documents``."""

    documents: DataFrame
    spans: DataFrame


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block: int = 256,
    seed: int = 11,
) -> Mix:
    """Mix documents (``doc_id, text, source``) by source.

    The sources in the order of their names, null last, weigh ``weights``, repeated; the mix has ``share`` times the
    words of all documents, and no source or document is taken more than ``most`` times. A null or blank text has no
    words and is never taken. A null source is a source; a null id is an id; rows alike are taken each for itself. An
    empty table gives no rows. The same rows give the same mix, however they are partitioned.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "mixing")
    sized = scratch.table(
        docs.select(
            F.col("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    sources = source_targets(sized, weights, share, most, block, scratch)
    documents = scratch.table(laid_out(sized, sources, seed, scratch))
    again = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    times = documents.filter("size > 0").select("*", again.alias("round"))
    first = F.col("round") * F.col("source_size") + F.col("start")
    taken = times.withColumn("low", first).withColumn("high", F.least(first + F.col("size"), F.col("words")))
    taken = taken.filter("low < high")
    ranks = F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block)))
    cut = taken.select("*", ranks.alias("rank"))
    begin = F.greatest("low", F.col("rank") * block)
    parts = cut.select(
        "source_no",
        "rank",
        "start",
        "doc_id",
        F.col("round"),
        (begin - F.col("rank") * block).alias("at"),
        (begin - F.col("low")).alias("first_word"),
        (F.least(F.col("high"), (F.col("rank") + 1) * block) - begin).alias("n_words"),
    )
    spans = parts.join(schedule(spark, sources, scratch), ["source_no", "rank"])
    return Mix(
        documents, spans.select("slot", "at", "doc_id", "first_word", "n_words", "round", "source_no", "start")
    )


def taken_words(mixed: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: every document, and the words that the mix takes of it."""
    sums = mixed.spans.groupBy("source_no", "start").agg(F.sum("n_words").alias("taken"))
    used = mixed.documents.filter("size > 0").join(sums, ["source_no", "start"], "left")
    unused = mixed.documents.filter("size = 0").withColumn("taken", F.lit(None).cast("long"))
    taken = F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    return used.unionByName(unused).select("doc_id", "size", "source_size", "target", taken)
