"""Line dedup: lines that occur in many documents go.

Explode the normalised lines of every document, hash them, count documents per hash, and put each document's other
lines together again by position. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted
from ledgerline.llm.common import Scratch, text_key, with_text

_BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_keys(text: Column, min_chars: int) -> Column:
    """128 bits for each line's key, by position; null for a key shorter than ``min_chars``."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)

    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(_BLANKS))
        both = F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b"))
        return F.when(F.length(bare) >= min_chars, both)

    return F.transform(_lines(lowered), key)


def frequent_line_flags(docs: DataFrame, min_documents: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``_ll_flags``: per line up to the last one that goes, whether its key is found in ``min_documents``
    documents or more; null if no line is.

    A key is the line with ASCII white space stripped and A-Z lower-cased; shorter keys than ``min_chars``, such as those
    of blank lines, are neither counted nor joined. Rows with one ``doc_id`` are one document; all rows without an id are
    one too. Only hashes are shuffled by line, and only frequent lines come back to their documents. A null text is
    one empty line.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    me = docs.select(
        F.col("doc_id").alias("_ll_id"),
        text_key(F.col("text")).alias("_ll_text"),
        _line_keys(F.col("text"), min_chars).alias("keys"),
    )
    keyed = scratch.table(me)
    frequent = (
        keyed.select("_ll_id", F.explode(F.array_distinct(F.filter("keys", lambda k: k.isNotNull()))).alias("key"))
        .select("key.a", "key.b", F.struct("_ll_id").alias("document"))
        .groupBy("a", "b")
        .agg(F.count_distinct("document").alias("documents"))
        .filter(F.col("documents") >= min_documents)
        .select("a", "b")
    )
    lines = keyed.select("_ll_id", "_ll_text", F.posexplode("keys").alias("pos", "key")).filter("key IS NOT NULL")
    lines = lines.select("_ll_id", "_ll_text", "pos", "key.a", "key.b").join(frequent, ["a", "b"])
    flags = lines.groupBy("_ll_id", "_ll_text").agg(F.array_sort(F.collect_set("pos")).alias("places"))
    flags = scratch.table(flags.select("_ll_id", "_ll_text", _flags_at(F.col("places")).alias("_ll_flags")))
    scratch.drop(keyed)
    same = F.col("doc_id").eqNullSafe(F.col("_ll_id")) & (text_key(F.col("text")) == F.col("_ll_text"))
    return docs.join(flags, same, "left").select(*[quoted(c) for c in docs.columns], "_ll_flags")


def _flags_at(places: Column) -> Column:
    """True at the given places, in rising order, and false before and between them."""

    def stretch(place: Column, k: Column) -> Column:
        before = F.coalesce(F.get(places, k - 1), F.lit(-1))
        return F.concat(F.array_repeat(F.lit(False), place - before - 1), F.array(F.lit(True)))

    return F.flatten(F.transform(places, stretch))


def kept_text(text: Column, flags: Column) -> Column:
    """The lines that are not flagged, joined by line feeds."""
    kept = F.zip_with(_lines(text), flags, lambda line, dropped: F.when(~F.coalesce(dropped, F.lit(False)), line))
    return F.when(flags.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n"))


def drop_frequent_lines(docs: DataFrame, min_documents: int = 10, min_chars: int = 1) -> DataFrame:
    """``doc_id``, ``kept_text``, ``n_lines`` before dropping, ``n_dropped``; one row per row of ``docs``."""
    flagged = frequent_line_flags(docs.select("doc_id", "text"), min_documents, min_chars)
    dropped = F.size(F.filter("_ll_flags", lambda d: d))
    return flagged.select(
        "doc_id",
        kept_text(F.col("text"), F.col("_ll_flags")).alias("kept_text"),
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.when(F.col("_ll_flags").isNull(), 0).otherwise(dropped).cast("long").alias("n_dropped"),
    )


def without_frequent_lines(docs: DataFrame, min_documents: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with its frequent lines gone; no row is lost, a text may become empty."""
    flagged = frequent_line_flags(docs, min_documents, min_chars)
    return with_text(flagged, kept_text(F.col("text"), F.col("_ll_flags"))).drop("_ll_flags")
