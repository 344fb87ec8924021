"""The pipeline's rows against a plain form of each stage."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import sentence, table, texts
from test_duplicates import near_copies, plain_cut, plain_groups
from test_lines_rules import plain_lines
from test_packing_pieces import plain_best_fit
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import quality_model
from ledgerline.llm.packing import tokenizer_file


def corpus():
    rows = {i: t for i, t in [*texts(), *near_copies(4)] if i is not None}
    rows |= {9000 + k: f"{sentence(k, 90)}\nline of many\n{sentence(700 + k, 40)}" for k in range(14)}
    rows |= {9100 + k: "buy now !!! $$$ ### " * 30 for k in range(5)}
    return sorted(rows.items())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, written and read again as ``run`` does."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    table(spark, corpus()).write.parquet(f"{folder}/documents.parquet")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{number}")
        docs = spark.read.parquet(f"{folder}/stage{number}")
        found.append(docs)
    return folder, found


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]


def test_classifier_stage(spark, stages):
    folder, found = stages
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in quality_model.classify(docs).collect() if r.kept}
    assert pairs(found[0]) == [(i, t) for i, t in corpus() if i in kept]
    assert kept < {i for i, _ in corpus()} and kept <= {i for i, t in corpus() if (t or "").split()}


def test_line_stage(stages):
    _, found = stages
    assert pairs(found[1]) == [(i, kept) for i, _, _, kept in plain_lines(pairs(found[0]), 10)]


def test_near_duplicate_stage(stages):
    _, found = stages
    before = pairs(found[1])
    firsts = {i for i, n, component in plain_groups(before, 5, 80) if i == component or not n}
    assert pairs(found[2]) == [(i, t) for i, t in before if i in firsts] and len(firsts) < len(before)


def test_substring_stage(stages):
    _, found = stages
    assert pairs(found[3]) == plain_cut(pairs(found[2]), 20)
    assert all(d.columns == found[0].columns for d in found[:4])


def test_packing_stage_and_whole_run(spark, stages):
    folder, found = stages
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = Counter()
    for i, t in pairs(found[3]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    whole = corpus_pipeline.run(spark, folder)
    got = whole.collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences: dict = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 2048
    assert len(sequences) == len(plain_best_fit([key[3] for key in want.elements()], 2048))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
