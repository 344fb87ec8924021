from __future__ import annotations

import hashlib
import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd_rows import sentence, table, texts
from tokenizers import Tokenizer

from ledgerline.llm import packing, pieces


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


ODD = [
    "", " ", "\n\n a", "<|endoftext|> a<|startoftext|>b", "<|ENDOFTEXT|> A", "it's WE'LL, it's.", "ΣΑΣ ας Σ.", "İx ſ ŉ ª ﬁ Á",
    "a b\x1cc\x85d e", "٣ ५ 中文, ก็ हिन्दी.", "b.. c., .d ,", "\U0001F600 ab\tcd\r\nef", "é. é, É.",
]


def test_word_ids_are_the_tokenizers(tokenizer):
    made = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"), most=500)  # forgets often
    for batch in [ODD, [t or "" for _, t in texts()], ODD[::-1]]:
        for text, ids in zip(batch, made.encode(batch)):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert ids == np.array(want, "<u4").tobytes(), text[:80]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.WordIds(public_tokenizers.path("byte_bpe_50k.json"))


def test_packing_fills_sequences(spark, tokenizer):
    rows = [*texts(), *((200 + k, sentence(k, 15 + k % 9)) for k in range(150))]
    capacity = 64
    got = packing.pack(table(spark, rows), capacity=capacity).collect()
    ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    want = [
        (i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
        for i, all_ids in ids
        for n, at in enumerate(range(0, len(all_ids), capacity))
        for part in [all_ids[at : at + capacity]]
    ]
    assert sorted(map(repr, [tuple(r)[:5] for r in got])) == sorted(map(repr, want))
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) == len(plain_best_fit([w[3] for w in want], capacity))


def test_every_letter_before_a_stop():
    """Whatever a letter becomes in the tokenizer, the word's ids are those of the word as a whole."""
    encoder = packing.WordIds(packing.tokenizer_file("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    made = [f"a{c}{stop}" for c in letters for stop in ".,"] + [f"{c}." for c in letters]
    for at in range(0, len(made), 20_000):
        some = made[at : at + 20_000]
        whole = encoder.tokenizer.encode_batch(some, add_special_tokens=False)
        wrong = [w for w, ids, e in zip(some, encoder.encode(some), whole) if ids != packing._packed(e.ids)]
        assert not wrong, wrong[:10]


def plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        room = min((r for r in rooms if r[0] >= length), default=None, key=lambda r: r[0])
        if room is None:
            room = [capacity]
            rooms.append(room)
        room[0] -= length
    return rooms


def test_plan_equals_best_fit_over_items():
    random.seed(4)
    for _ in range(300):
        counts = {random.randint(1, 64): random.randint(1, 60) for _ in range(random.randint(1, 40))}
        runs, ranks, rooms = packing.best_fit(dict(counts), 64), defaultdict(int), defaultdict(int)
        for length, rank, documents, first, _ in runs:
            assert rank == ranks[length]
            ranks[length] += documents
            for k in range(documents):
                rooms[first + k] += length
        assert ranks == counts and max(rooms.values()) <= 64
        assert len(rooms) == len(plain_best_fit([n for n, c in counts.items() for _ in range(c)], 64))


def test_packing_an_empty_table(spark):
    assert packing.pack(table(spark, [])).collect() == []


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model():
    return pieces.piece_model("piece_bpe_32k.model")


def expected(library, text):
    ids = [*library.encode(text or ""), library.eos_id()]
    return " ".join(map(str, ids)), library.decode(ids), len(ids)


def test_encoding_equals_the_library(model, library):
    random.seed(9)
    chars = [*" ▁ \n\t  aabbttheions", *map(chr, (0, 1, 0xDF, 0xE9, 0x1F600, 0xFEFF, 0x4E2D, 0x301))]
    known = list(model.id_of)
    made = ["".join(random.choices(chars, k=random.randint(0, 60))) for _ in range(4000)]
    made += ["".join(random.choices(known, k=random.randint(1, 8))) for _ in range(4000)]
    made += [" " * k + "a" * j for k in range(50) for j in range(5)] + ["a" * 3000, " " * 3000, *ODD]
    made += [t for _, t in texts()]
    wrong = [text for text in made if model.encode(text or "") != expected(library, text)]
    assert not wrong, wrong[:3]


def test_every_whole_text(spark, library):
    got = pieces.encode_pieces(table(spark)).collect()
    want = []
    for i, t in texts():
        ids, back, n = expected(library, t)
        want.append((i, n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids, back))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert pieces.encode_pieces(table(spark, [])).collect() == []
