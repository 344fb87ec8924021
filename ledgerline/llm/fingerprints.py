"""Document fingerprints: a quartile digest of hashed byte triplets, and a bounded difference between two digests.

The triplets within each window of five bytes are hashed to 256 buckets and counted. Each bucket's count is encoded
by the quartile it falls in, two bits a bucket, behind a code of the length and of the quartiles' ratios. Digests of
texts that share most of their bytes differ in few buckets, wherever the shared bytes stand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, text_key, texts

BUCKETS = 256
_PAIRS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))  # places of the other two bytes behind the first
_TABLES = np.random.RandomState(20).randint(0, BUCKETS, (3 * len(_PAIRS), 256)).astype(np.uint8)
_HEADER = 3  # bytes: length, and two ratios


def counts(data: bytes) -> np.ndarray:
    """Triplets per bucket."""
    raw = np.frombuffer(data, np.uint8)
    total = np.zeros(BUCKETS, np.int64)
    for k, (i, j) in enumerate(_PAIRS):
        n = raw.size - j
        if n > 0:
            first, second, third = _TABLES[3 * k : 3 * k + 3]
            total += np.bincount(first[raw[:n]] ^ second[raw[i : i + n]] ^ third[raw[j:]], minlength=BUCKETS)
    return total


def digest(text: str) -> bytes:
    """The fingerprint of a text; the same for equal texts. A text too short for a triplet has an empty body."""
    data = text.encode()
    found = counts(data)
    q1, q2, q3 = np.sort(found)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (found > q1).astype(np.uint8) + (found > q2) + (found > q3)
    body = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = min(255, int(np.log2(len(data) + 1) * 8))
    ratios = [int(100 * q // max(q3, 1)) for q in (q1, q2)]
    return bytes([length, *ratios]) + body.astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, down to 0 at the bound: the mean quartile distance of two independent digests and more.

    The difference adds up the buckets' quartile distances, where opposite ends count double, and small parts
    for the lengths and ratios.
    """
    if a == b:
        return 1.0
    x, y = (np.frombuffer(d, np.uint8) for d in (a, b))
    header = np.abs(x[:_HEADER].astype(int) - y[:_HEADER])
    apart = np.abs(_codes(x) - _codes(y))
    score = int(apart.sum()) + 3 * int((apart == 3).sum()) + min(40, int(header[0])) + min(20, int(header[1:].sum()) // 4)
    return max(0.0, 1.0 - score / (BUCKETS * 1.6))


def _codes(digest_bytes: np.ndarray) -> np.ndarray:
    body = digest_bytes[_HEADER:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3
    return body.astype(np.int8).ravel()


_ROW = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(text: str, own: bytes, behind: str, behind_digest: bytes) -> dict:
    quarter = len(text) // 4
    edited = text[: len(text) - quarter] + behind[:quarter]
    changed = digest(edited)
    return {
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": own.hex(),
        "edited_fingerprint": changed.hex(),
        "near_edited": likeness(own, changed),
        "near_next": likeness(own, behind_digest),
    }


def _neighbours(ranged: DataFrame) -> DataFrame:
    """Rows of all but the last document of each range; that one and the first with their texts (``edge``)."""
    id_type = ranged.schema["doc_id"].dataType.simpleString()
    types = {"doc_id": None, "edge": pa.string(), "range": pa.int64(), "text": pa.string(), "n_chars": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, number = None, TaskContext.get().partitionId()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                own = digest(text)
                if held is None:
                    out.append({"doc_id": doc_id, "edge": "first", "range": number, "text": text})
                else:
                    out.append({"doc_id": held[0], **_row(held[1], held[2], text, own)})
                held = (doc_id, text, own)
            types["doc_id"] = batch.schema.field(0).type
            if out:
                yield _batch(out, types)
        if held:
            yield _batch([{"doc_id": held[0], "edge": "last", "range": number, "text": held[1]}], types)

    return ranged.mapInArrow(run, f"doc_id {id_type}, edge string, range long, text string, {_ROW}")


def _batch(rows: list[dict], types: dict) -> pa.RecordBatch:
    names = [*types, *[f.split()[0] for f in _ROW.split(", ") if f.split()[0] not in types]]
    kinds = [types.get(n) or (pa.float64() if n.startswith("near") else pa.string()) for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds)], names)


def fingerprint_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text and of its edited text: the last quarter replaced by as many of the first
    code points of the next document in ascending ``doc_id`` (after the last: the first).

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``; one row per
    row of ``docs``. Null texts are empty; null ids come first; rows of one id are ordered by a hash of their text.
    Documents are range-partitioned once, and read in order in each range. Only the first and last document of each
    range meet in a second step, two rows per range.
    """
    source = texts(docs)
    ranged = (
        source.withColumn("_key", text_key(F.col("text")))
        .repartitionByRange("doc_id", "_key")
        .sortWithinPartitions("doc_id", "_key")
        .select("doc_id", "text")
    )
    found = Scratch(docs.sparkSession, "fingerprints").table(_neighbours(ranged))
    columns = ["doc_id", *[f.split()[0] for f in _ROW.split(", ")]]
    inner = found.filter("edge is null").select(*columns)
    edges = found.filter("edge is not null")
    firsts = edges.filter("edge = 'first'").select(F.col("range").alias("of"), F.col("text").alias("behind"))
    # Range numbers only, one row per range: this window holds no texts.
    order = Window.orderBy("range")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = edges.filter("edge = 'last'").select(
        F.col("range").alias("last_of"),
        F.coalesce(F.lead("range").over(order), F.min("range").over(everything)).alias("of"),
    )
    lasts = edges.filter("edge = 'last'").select("doc_id", "text", F.col("range").alias("last_of"))
    pairs = lasts.join(chain, "last_of").join(firsts, "of").select("doc_id", "text", "behind")
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                {"doc_id": doc_id, **_row(text, digest(text), behind, digest(behind))}
                for doc_id, text, behind in zip(*(batch.column(k).to_pylist() for k in range(3)))
            ]
            if out:
                yield _batch(out, {"doc_id": batch.schema.field(0).type, "n_chars": pa.int64()})

    return inner.unionByName(pairs.mapInArrow(run, f"doc_id {id_type}, {_ROW}"))
