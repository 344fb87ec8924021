"""Importance resampling towards a target distribution over hashed word features.

Words are found in the bytes of a whole batch at once. The distinct features of a batch are grouped by their length in
bytes, each length is a matrix of bytes, and the CRCs of all its rows are updated column by column; their buckets are then
scattered back to the features' places.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, texts
from ledgerline.operators.numbering import sequence_numbers

_SEGMENT = 4_000_000  # bytes of text that are split into words at a time
_WIDEST = 1024  # columns of a matrix; longer features are rare and go one by one
_CELLS = 8_000_000


def _crc_table() -> np.ndarray:
    """The 256 steps of the reflected CRC-32 with the polynomial EDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def _word_bytes() -> np.ndarray:
    """Per byte: 0 if it separates words, else the byte, A-Z as a-z. Bytes from 128 on belong to words."""
    kinds = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        kinds[low : high + 1] = np.arange(low, high + 1)
    kinds[0x41:0x5B] = np.arange(0x61, 0x7B)
    return kinds


_WORD = _word_bytes()


def crc32_rows(values: pa.Array) -> np.ndarray:
    """The CRC-32 of each value of a binary array."""
    _, offsets, data = values.buffers()
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lengths, out = np.diff(offsets), np.zeros(len(values), np.uint32)
    order = np.argsort(lengths, kind="stable")
    distinct, firsts = np.unique(lengths[order], return_index=True)
    for length, rows in zip(distinct.tolist(), np.split(order, firsts[1:])):
        if length > _WIDEST:
            for row in rows:
                out[row] = zlib.crc32(data[offsets[row] : offsets[row + 1]])
            continue
        step = max(1, _CELLS // max(1, length))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            columns = data[offsets[some][None, :] + np.arange(length)[:, None]]
            crc = np.full(len(some), 0xFFFFFFFF, np.uint32)
            for column in columns:
                crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[some] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _segments(data: np.ndarray, bounds: np.ndarray, whole: bool) -> Iterator[tuple[int, int]]:
    """Stretches of about ``_SEGMENT`` bytes that end between documents or, unless ``whole``, between words."""
    low = 0
    while low < len(data):
        high = min(low + _SEGMENT, len(data))
        document_end = int(bounds[np.searchsorted(bounds, high)])
        if not whole:
            for at in range(high, document_end, _SEGMENT):
                breaks = np.flatnonzero(_WORD[data[at : min(at + _SEGMENT, document_end)]] == 0)
                if len(breaks):
                    document_end = at + int(breaks[0])
                    break
        yield low, document_end
        low = document_end


def _words(data: np.ndarray, bounds: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the words of a stretch one after the other, their lengths, and their places in ``data``."""
    letters = _WORD[data[low:high]]
    inside = letters != 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = bounds[np.searchsorted(bounds, low, "right") : np.searchsorted(bounds, high)] - low
    begins[cuts] |= inside[cuts]  # a word ends with its document
    ends[cuts - 1] |= inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return letters[inside], np.flatnonzero(ends) - starts + 1, starts + low


def _runs(letters: np.ndarray, lengths: np.ndarray, rows: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
    """All runs of ``n`` words of one document, joined by one blank, and their documents."""
    if n == 1:
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return _binary(letters, ends), rows
    spaced = np.concatenate(([0], np.cumsum(lengths + 1)))
    text = np.full(int(spaced[-1]), 0x20, np.uint8)
    gaps = np.zeros(len(text), bool)
    gaps[spaced[1:] - 1] = True
    text[~gaps] = letters
    firsts = np.flatnonzero(rows[: max(0, len(rows) - n + 1)] == rows[n - 1 :])
    sizes = spaced[firsts + n] - 1 - spaced[firsts]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    places = np.repeat(spaced[firsts] - ends[:-1], sizes) + np.arange(int(ends[-1]))
    return _binary(text[places], ends), rows[firsts]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


def feature_buckets(column: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each stretch of a batch of texts: the bucket of every feature, the feature's row, and the words' rows."""
    whole = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    texts = whole.fill_null("").cast(pa.large_binary())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    for low, high in _segments(data, bounds, longest > 1):
        letters, lengths, places = _words(data, bounds, low, high)
        rows = np.searchsorted(bounds, places, "right") - 1
        found, owners = [], []
        for n in range(1, longest + 1):
            features, of = _runs(letters, lengths, rows, n)
            encoded = features.dictionary_encode()
            codes = crc32_rows(encoded.dictionary).astype(np.int64) % buckets
            found.append(codes[encoded.indices.to_numpy(zero_copy_only=False)])
            owners.append(of)
        yield np.concatenate(found), np.concatenate(owners), rows


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends its sums, ``buckets`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for found, _, _ in feature_buckets(batch.column(0), longest, buckets):
                sums += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], ["bucket", "n"])

    counted = texts(docs).select("text").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln(ratio of the smoothed shares))`` per bucket."""
    extra = len(raw)
    s_all, t_all = float(int(raw.sum()) + extra), float(int(target.sum()) + extra)
    ratios = ((float(t) + 1.0) * s_all / ((float(s) + 1.0) * t_all) for s, t in zip(raw.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _noise(seed: int, doc_id: object) -> int:
    """The document's own draw of a Gumbel variable, in thousandths."""
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, longest: int, seed: int) -> DataFrame:
    """``doc_id, n_features, n_words, weight, score`` of every document."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            features, words, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for found, owners, rows in feature_buckets(batch.column(1), longest, buckets):
                features += np.bincount(owners, minlength=n)
                words += np.bincount(rows, minlength=n)
                sums = np.bincount(owners, weights=gains[found], minlength=n)  # whole numbers, far below 2 ** 53
                weight += sums.astype(np.int64)
            noise = np.array([_noise(seed, i) for i in batch.column(0).to_pylist()], np.int64)
            columns = [features, words, weight, weight + noise]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], ["doc_id", "n_features", "n_words", "weight", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(run, f"doc_id {kind}, n_features long, n_words long, weight long, score long")


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """Draw ``percent`` of the documents with ``least_words`` words or more, without replacement, with weights that grow
    with their likeness to ``target`` (a frame with ``text``): ``doc_id, n_features, weight, score, rank``.

    Features are all runs of 1 to ``longest`` words. ``rank`` is 1, 2, 3, ... by falling score, ties by id, and null for
    documents not drawn. A null or wordless text has no features and weight 0; a null id draws as an empty text and
    comes first among ties; rows alike are drawn each for itself; an empty target counts nothing. Two passes over the
    texts and one range shuffle of narrow rows; only ``buckets`` sums reach the driver.
    """
    scratch = Scratch(spark, "resampling")
    raw = bucket_counts(docs, longest, buckets)
    wanted = bucket_counts(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets)
    judged = scratch.table(scored(docs, bucket_gains(raw, wanted), longest, seed))
    enough = F.col("n_words") >= least_words
    drawn = judged.filter(enough).count() * percent // 100
    numbered = sequence_numbers(
        judged.filter(enough).withColumn("_down", -F.col("score")), ["_down", "doc_id"], "rank"
    ).drop("_down")
    ranked = numbered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = judged.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
