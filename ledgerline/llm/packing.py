"""Best-fit packing of documents into training sequences, planned on the histogram of lengths.

Documents are tokenised and cut where they are; only lengths and ranks are shuffled. Best fit, longest first, runs
over the counts of the at most ``capacity`` distinct lengths, so the plan costs the same for any number of
documents: a class of equal bins is filled or split as one. The plan is a list of runs "documents of length L with
ranks a to b take offset o of sequences s onwards", and each document finds its run by length and rank.
"""

from __future__ import annotations

import bisect
import os
import struct
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, kept, texts, tokenizer_file

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"
_SALTS = 32


class WordIds:
    """The little-endian 32-bit ids of texts, as bytes.

    The tokenizer lower-cases, composes, turns white space into one blank, and splits letters from marks and at blanks, so
    no token crosses a blank, or a full stop or comma behind what is a single letter also after that (some letters become
    a letter and a mark). Words can be encoded one by one, without regard to the case of A-Z, and remembered; the words
    of a batch that are new are encoded together. Two generations of remembered words are kept, each of ``most``
    characters at most and a batch.
    """

    def __init__(self, file: str, most: int = 6_000_000) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already take all cores
        self.tokenizer, self.most = Tokenizer.from_file(file), most
        self.known, self.older, self.held = {}, {}, 0
        probe = "A pr\u00f6be\u00e9, of \u00a0 what.\nit's  for."
        if b"".join(self.encode([probe])) != _packed(self.tokenizer.encode(probe, add_special_tokens=False).ids):
            raise ValueError("not a tokenizer that drops blanks and letters' case")

    def _encode_new(self, words: list[str]) -> None:
        """Lower-case letters alone pass normaliser and splitter as they are, so the model takes them directly."""
        tokenize, known, rest = self.tokenizer.model.tokenize, self.known, []
        for word in words:
            if not (word.isalpha() and word.islower()):
                rest.append(word)
            elif word.isascii():
                known[word] = _packed([token.id for token in tokenize(word)])
            elif word.lower() == word and is_normalized("NFC", word):
                plain = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
                known[word] = _packed([token.id for token in tokenize(plain)])
            else:
                rest.append(word)
        for word, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.known[word] = _packed(found.ids)

    def encode(self, batch: list[str]) -> Iterator[bytes]:
        split = [_words(text) for text in batch]
        if self.held > self.most:
            self.known, self.older, self.held = {}, self.known, 0
        new = set().union(*split).difference(self.known)
        again = new & self.older.keys()
        self.known.update((word, self.older[word]) for word in again)
        new -= again
        ended = [word for word in new if word[-1:] in _STOPS and _stays_a_letter(word[-2:-1])]
        stems = new.difference(ended)
        stems.update(_STOPS, (word[:-1] for word in ended))
        self._encode_new(list(stems.difference(self.known)))
        for word in ended:
            self.known[word] = self.known[word[:-1]] + self.known[word[-1]]
        self.held += sum(map(len, new)) + sum(map(len, again))
        look = self.known.__getitem__
        for listed in split:
            yield b"".join(map(look, listed))


_STOPS = (".", ",")


def _stays_a_letter(character: str) -> bool:
    """True for a letter that is one letter after lower-casing and composition too."""
    if character.isascii():
        return character.isalpha()
    changed = normalize("NFC", character.lower())
    return character.isalpha() and len(changed) == 1 and changed.isalpha()


# Byte-level letters: a printable Latin-1 byte stands for itself, the others for letters from U+0100 on.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = dict(zip([b for b in range(256) if b not in _OWN], map(chr, range(256, 512))))


_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]  # most words have fewer ids


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


def _words(text: str) -> list[str]:
    if "<|" not in text:  # the tokenizer's special tokens are told by case
        text = text.encode().lower().decode()
    return text.replace("\n", " ").split(" ")


def _word_ids(name: str) -> WordIds:
    return kept(f"word ids of {name}", lambda: WordIds(tokenizer_file(name)))


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece: the ids of a text and ``end_id``, cut every ``capacity`` ids. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _word_ids(tokenizer).encode, struct.pack("<I", end_id)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            encoded = (ids for part in _parts(batch.column(1)) for ids in encode(part))
            for row, found in enumerate(encoded):
                ids = memoryview(found + end)
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(run, PIECES.format(id=id_type))


def _parts(column: pa.Array, characters: int = 2_000_000) -> Iterator[list[str]]:
    """A column's texts, null as empty, in lists of about so many characters."""
    part, held = [], 0
    for text in column.to_pylist():
        part.append(text or "")
        held += len(part[-1])
        if held > characters:
            yield part
            part, held = [], 0
    yield part


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs ``(length, first rank, documents, first sequence, offset)``.

    The bins of a class hold the same lengths and have consecutive numbers. An item goes to the fullest bin it
    fits, so equal items fill the bins of a class one after the other; this takes or splits the class in one step,
    and each length adds three classes at most. Runs of a length cover its ranks from 0 without a gap.
    """
    by_room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    runs, opened = [], 0

    def add(room: int, first: int, bins: int) -> None:
        if bins and room:
            if room not in by_room:
                by_room[room] = []
                bisect.insort(rooms, room)
            by_room[room].append((first, bins))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, bins = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room, first, bins = capacity, opened, -(-left // (capacity // length))
                opened += bins
            each = room // length  # a bin that takes one is the fullest that fits the next
            full = min(bins, left // each)
            for some, items in ((full, each), (1, left - full * each if full < bins else 0)):
                if some and items:
                    for slot in range(items):
                        runs.append((length, rank, some, first, capacity - room + slot * length))
                        rank += some
                    add(room - items * length, first, some)
                    first, bins, left = first + some, bins - some, left - some * items
            add(room, first, bins)
    return runs


def _placed(ranked: DataFrame, runs: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The run of each piece by length and rank. The runs depend on the lengths that occur, not on how many
    documents have them; they travel with the function as five columns of numbers."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    top = int(table[:, 1].max(initial=0)) + int(table[:, 2].max(initial=0)) + 1
    keys = table[:, 0] * top + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "rank"))
            found = np.searchsorted(keys, length * top + rank, side="right") - 1
            sequence = table[found, 3] + rank - table[found, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(table[found, 4], pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    id_type = ranked.schema["doc_id"].dataType.simpleString()
    schema = PIECES.format(id=id_type) + ", sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Every piece of every document with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``.

    Pieces of one length are ranked within 32 salts and the salts' counts are added up, so a length that most
    documents share is ranked by many tasks. An empty or null text is the end id alone; an empty table gives no
    rows; rows with equal ids are packed each on their own.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = pieces(docs, tokenizer, capacity, end_id).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(_SALTS)).cast("int")
    )
    cut = scratch.table(cut)
    salted = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.select("length", "salt", "here", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    counts = salted.groupBy("length").agg(F.sum("here").alias("n")).collect()  # at most one row per length
    runs = best_fit({row["length"]: row["n"] for row in counts}, capacity)
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        cut.withColumn("place", F.row_number().over(within))
        .join(F.broadcast(starts), ["length", "salt"])  # at most capacity * 32 rows of numbers
        .withColumn("rank", (F.col("before") + F.col("place") - 1).cast("long"))
    )
    return _placed(ranked, runs)
