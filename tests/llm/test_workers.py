"""What a Python worker holds between tasks and operators, and hashes made without a memo."""

from __future__ import annotations

import gc
import random
import weakref

import numpy as np
import pyarrow as pa
import xxhash

from ledgerline.llm import jaccard_join, packing, quality_model


class Captured:
    """Stands for a frame; gives back the function that its tasks would run."""

    columns, schema = ["text"], "text string"

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_a_worker_lets_go_of_another_operators_words(monkeypatch):
    model = quality_model.Model(np.ones((8, 6, 3)), np.ones(6), np.zeros(quality_model.DIMS))
    monkeypatch.setattr(quality_model, "train", lambda docs, sample: model)
    run = quality_model.good_documents(Captured())
    held = weakref.ref(packing._word_ids("word_bpe_49k.json"))
    assert packing._word_ids("word_bpe_49k.json") is held()  # kept from task to task
    texts = [f"word{k} and more words" if k % 3 else None for k in range(2_500)]
    found = list(run(iter([pa.RecordBatch.from_pydict({"text": texts}), pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})])))
    gc.collect()
    assert held() is None
    assert max(batch.num_rows for batch in found) <= 1_000  # few texts at a time as Python objects
    assert [t for batch in found for t in batch.column(0).to_pylist()] == [t for t in texts if t]


def plain_set(words, size):
    whole, step = 2**64, 0x9E3779B97F4A7C15
    size, out = min(size, len(words)), set()
    for k in range(len(words) - size + 1 if words else 0):
        x = size
        for word in words[k : k + size]:
            x = (x * step + xxhash.xxh3_64_intdigest(word)) % whole
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % whole
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % whole
        out.add(x ^ (x >> 31))
    return sorted(out)


def test_shingle_sets_need_no_memo_of_words():
    random.seed(3)
    for n in [0, 1, 3, 4, 5, 40, 700]:
        for size in (1, 4, 5):
            words = [random.choice([b"a", b"b", b"\xc3\xa9", b"long" * 90]) for _ in range(n)]
            found = jaccard_join.shingle_set(words, size)
            assert found.dtype == np.uint64 and found.tolist() == plain_set(words, size)
