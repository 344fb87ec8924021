"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 16 bytes decides, at each blank, whether a chunk ends there, so a passage falls into
the same chunks wherever it stands, whatever was inserted before it, save for its two ends. A chunk is a repeat if its
digest is found in a document with a smaller id, or earlier in its own document. Runs of repeats with ``min_words``
words or more are cut out; the first copy of every chunk stays.

A chunk is four words on average, so a passage of 50 words has a run of 20 or more inside but for a few in a thousand
cases, while phrases that texts share by chance are shorter.

Where a text has no such end for 256 bytes, as in scripts written without blanks, the same hash ends chunks between any two
characters, 12 characters apart on average, and two characters count as a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted
from ledgerline.llm.common import Scratch, forget, sliced, text_key, texts, with_text

WINDOW, LONGEST = 16, 256  # bytes the hash looks back; a stretch without a cut is cut after so many bytes
_GEAR = np.random.RandomState(8).randint(0, 2**32, 256, np.uint32)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_CUT_BELOW, _CLOSE_BELOW = np.uint32(2**32 // 4), np.uint32(2**32 // 12)


def cuts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of a text's bytes, the last one the text's end; and whether each chunk lies where there is no
    blank to end one."""
    rolled, width = _GEAR[raw], 1
    while width < WINDOW:
        shifted = rolled[:-width] << np.uint32(width)
        rolled = rolled.copy()
        rolled[width:] += shifted
        width *= 2
    ends = np.flatnonzero(_BLANK[raw] & (rolled < _CUT_BELOW)) + 1
    if not raw.size or not ends.size or ends[-1] != raw.size:
        ends = np.append(ends, raw.size)
    starts = np.concatenate(([0], ends[:-1]))
    wide = ends - starts > LONGEST
    if not wide.any():
        return ends, wide
    covered = np.zeros(raw.size + 1, np.int8)
    np.add.at(covered, starts[wide], 1)
    np.add.at(covered, ends[wide], -1)
    covered = np.cumsum(covered[:-1]).astype(bool)
    close = np.zeros(raw.size, bool)
    close[:-1] = (raw[1:] & 0xC0) != 0x80
    close &= covered & (rolled < _CLOSE_BELOW)
    ends = np.union1d(ends, np.flatnonzero(close) + 1)
    starts, more = np.concatenate(([0], ends[:-1])), [ends]
    for start, end in zip(starts, ends):
        if end - start > LONGEST:  # such as one letter over and over
            at = np.arange(start + LONGEST, end, LONGEST)
            while (inside := (raw[at] & 0xC0) == 0x80).any():  # not within a character
                at = at - inside
            more.append(at)
    ends = np.unique(np.concatenate(more))
    return ends, covered[np.concatenate(([0], ends[:-1]))]


def chunks(text: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Digests, code points and words of a text's chunks; two characters are a word where there are no blanks."""
    import xxhash

    raw = np.frombuffer(text, np.uint8)
    if not raw.size:
        return [], np.empty(0, np.int64), np.empty(0, np.int64)
    ends, wide = cuts(raw)
    at = [0, *ends.tolist()]
    digests = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(at, at[1:])]
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    blank = _BLANK[raw]
    begins = ~blank & np.concatenate(([True], blank[:-1]))
    counted = np.concatenate(([0], np.cumsum(begins)))
    chars, words = np.diff(points[at]), np.diff(counted[at])
    return digests, chars, np.where(wide, np.maximum(words, (chars + 1) // 2), words)


def _chunked(docs: DataFrame) -> DataFrame:
    """Per document: a row number, its chunks' digests, their code points and words, and which came earlier in it."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        forget()
        at = TaskContext.get().partitionId() << 33
        for batch in sliced(batches):
            n = batch.num_rows
            found = [chunks(text or b"") for text in batch.column(1).to_pylist()]
            digests = [np.array(f[0], np.uint64) for f in found]
            again = []
            for d in digests:
                once = np.zeros(d.size, bool)
                once[np.unique(d, return_index=True)[1]] = True
                again.append(~once)
            ends = pa.array(np.cumsum([0, *map(len, digests)]).astype(np.int32))
            lists = [np.concatenate(digests).view(np.int64)]
            lists += [np.concatenate([f[k] for f in found]).astype(np.int32) for k in (1, 2)] + [np.concatenate(again)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(np.arange(at, at + n)),
                    *[pa.ListArray.from_arrays(ends, pa.array(values)) for values in lists],
                ],
                ["doc_id", "text_key", "row", "digests", "chars", "words", "again"],
            )
            at += n

    narrow = texts(docs).select("doc_id", F.encode("text", "utf-8").alias("text"), text_key(F.col("text")).alias("text_key"))
    schema = f"doc_id {id_type}, text_key long, row long, digests array<long>, chars array<int>, words array<int>, again array<boolean>"
    return narrow.mapInArrow(run, schema)


def repeated_runs(repeat: np.ndarray, n_words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """First and last-plus-one chunk of each run of repeats with ``min_words`` words or more."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], repeat, [False])).astype(np.int8)))
    total = np.concatenate(([0], np.cumsum(n_words)))
    return [(a, b) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()) if total[b] - total[a] >= min_words]


def repeated_spans(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """Documents with something to cut: ``doc_id, text_key``, ``kept`` and ``cut`` (arrays of ``start``, ``length``
    in code points), and ``first_docs``, where the first copies are.

    Only digests are shuffled; a digest is pre-aggregated before the shuffle, and found again by a join that Spark
    splits where one digest is frequent. Rows of one ``doc_id`` count as one document.
    """
    scratch = Scratch(docs.sparkSession, "chunks")
    chunked = scratch.table(_chunked(docs))
    id_type = chunked.schema["doc_id"].dataType.simpleString()
    shared = scratch.table(
        chunked.filter("doc_id IS NOT NULL")
        .select("doc_id", F.explode("digests").alias("digest"))
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first <> last")
        .select("digest", "first")
    )
    found = chunked.select("row", F.posexplode("digests").alias("pos", "digest")).join(shared, "digest")
    found = scratch.table(found.groupBy("row").agg(F.collect_list(F.struct("pos", "first")).alias("elsewhere")))
    scratch.drop(shared)
    own = F.exists("again", lambda x: x)
    marked = chunked.select("row", "doc_id", "text_key", "chars", "words", "again", own.alias("own"))
    marked = marked.join(found, "row", "left").filter("own OR elsewhere IS NOT NULL").select(
        "doc_id", "text_key", "chars", "words", "again", F.col("elsewhere.pos").alias("pos"), F.col("elsewhere.first").alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            rows, kept, cut, firsts = [], [], [], []
            doc_ids = batch.column(0).to_pylist()
            for row, doc_id in enumerate(doc_ids):
                value = lambda k: batch.column(k)[row].values  # noqa: B023, E731
                chars, n_words = (value(k).to_numpy() for k in (2, 3))
                repeat = value(4).to_numpy(zero_copy_only=False).copy()
                where = {}
                if batch.column(5)[row].is_valid:
                    where = {p: f for p, f in zip(value(5).to_pylist(), value(6).to_pylist()) if f != doc_id}
                    repeat[list(where)] = True
                runs = repeated_runs(repeat, n_words, min_words)
                if not runs:
                    continue
                at = np.concatenate(([0], np.cumsum(chars))).tolist()
                edges = [0, *[e for pair in runs for e in pair], chars.size]
                pieces = [{"start": at[a], "length": at[b] - at[a]} for a, b in zip(edges, edges[1:])]
                rows.append(row)
                kept.append([p for p in pieces[0::2] if p["length"]])
                cut.append(pieces[1::2])
                firsts.append(sorted({where[p] for a, b in runs for p in range(a, b) if p in where}))
            if rows:
                taken = batch.select([0, 1]).take(pa.array(rows))
                ids = pa.array(firsts, pa.list_(batch.schema.field(0).type))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(kept, span), pa.array(cut, span), ids],
                    ["doc_id", "text_key", "kept", "cut", "first_docs"],
                )

    spans = "array<struct<start: long, length: long>>"
    schema = f"doc_id {id_type}, text_key long, kept {spans}, cut {spans}, first_docs array<{id_type}>"
    spans = scratch.table(marked.mapInArrow(run, schema))
    scratch.drop(chunked, found)
    return spans


def _spanned(docs: DataFrame, min_words: int) -> DataFrame:
    spans = repeated_spans(docs, min_words).select(
        F.col("doc_id").alias("_ll_id"), F.col("text_key").alias("_ll_key"), F.col("kept").alias("_ll_kept"),
        F.col("cut").alias("_ll_cut"), F.col("first_docs").alias("_ll_first"),
    ).dropDuplicates(["_ll_id", "_ll_key"])
    same = F.col("doc_id").eqNullSafe(F.col("_ll_id")) & (text_key(F.col("text")) == F.col("_ll_key"))
    return docs.join(spans, same, "left")


def _kept(text: Column) -> Column:
    parts = F.transform("_ll_kept", lambda s: F.substring(text, s["start"].cast("int") + 1, s["length"].cast("int")))
    return F.when(F.col("_ll_kept").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(parts, ""))


def cut_repeats(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """``doc_id, kept_text, n_chars`` (before), ``n_cut`` (code points), ``cut`` (spans) and ``first_docs``; one row
    per row of ``docs``.

    Null texts are empty. A copy of a whole document may be left empty. Rows equal in id and text are one document:
    both stay. A document without an id is only compared with itself.
    """
    found = _spanned(docs.select("doc_id", "text"), min_words)
    return found.select(
        "doc_id",
        _kept(F.col("text")).alias("kept_text"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.coalesce(F.aggregate("_ll_cut", F.lit(0).cast("long"), lambda n, s: n + s["length"]), F.lit(0)).cast("long").alias("n_cut"),
        F.coalesce("_ll_cut", F.array().cast("array<struct<start: long, length: long>>")).alias("cut"),
        F.coalesce("_ll_first", F.array().cast(found.schema["_ll_first"].dataType)).alias("first_docs"),
    )


def without_repeats(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """``docs`` with repeated passages cut; no row is lost, a text may become empty."""
    return with_text(_spanned(docs, min_words), _kept(F.col("text"))).select(*[quoted(c) for c in docs.columns])
