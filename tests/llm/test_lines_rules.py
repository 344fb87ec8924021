from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from odd_rows import table, texts
from pyspark.sql import functions as F

from ledgerline.llm import line_dedup, rule_ledger

BLANKS = " \t\n\x0b\x0c\r"


def lower(text: str) -> str:
    return text.encode().lower().decode()


def plain_lines(rows, least):
    keys = [[lower(line).strip(BLANKS) for line in (t or "").split("\n")] for _, t in rows]
    found = Counter(k for k, _ in {(k, i) for (i, _), doc in zip(rows, keys) for k in doc if k})  # documents by id
    out = []
    for (i, t), doc in zip(rows, keys):
        lines = (t or "").split("\n")
        kept = [line for line, k in zip(lines, doc) if not k or found[k] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("least", [2, 10])
def test_lines(spark, least):
    got = line_dedup.drop_frequent_lines(table(spark), least).collect()
    assert sorted(map(repr, [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got])) == sorted(
        map(repr, plain_lines(texts(), least))
    )


def test_documents_are_counted_by_id(spark):
    rows = [(1, f"often\n{k}") for k in range(12)] + [(None, f"nobody's\n{k}") for k in range(12)]
    rows += [(100 + k, "in ten\n\nin nine" if k < 9 else "in ten") for k in range(10)]
    got = line_dedup.drop_frequent_lines(table(spark, rows)).collect()
    want = plain_lines(rows, 10)
    assert sorted(map(repr, [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got])) == sorted(map(repr, want))
    assert sum(r.n_dropped for r in got) == 10


def test_blank_lines_are_not_joined(spark):
    rows = [(k, "\n".join(f"line {k} {j}\n \t" for j in range(20))) for k in range(300)]
    flagged = line_dedup.frequent_line_flags(table(spark, rows))
    assert flagged.filter("_ll_flags IS NOT NULL").count() == 0
    keyed = line_dedup._line_keys(F.col("text"), 1)
    assert table(spark, rows).select(F.explode(keyed).alias("k")).filter("k IS NULL").count() == 6000


def test_line_stage_keeps_columns_and_rows(spark):
    docs = table(spark)
    out = line_dedup.without_frequent_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    assert len(rows) == len(texts()) and all(r.n_chars == len(r.text) for r in rows)
    assert all("shared" not in r.text.lower() for r in rows)


def test_line_dedup_is_native(spark):
    plan = line_dedup.drop_frequent_lines(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_measures_and_verdict(spark):
    rows = [*texts(), (90, "a b c a b c a"), (91, "### ** " * 40), (92, "LOUD WORDS!! " * 5 + "x")]
    judged = rule_ledger.judged(table(spark, rows)).collect()
    got = [(r.doc_id, tuple(r[m] for m in rule_ledger.MEASURES[:5]), r.base_failed) for r in judged]
    want = []
    for i, t in rows:
        m = plain_measures(t)
        want.append((i, m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert all(not r.kept for r in judged if r.base_failed)


def test_bits_policies_and_ablation(spark):
    ledger = rule_ledger.ledger(table(spark)).cache()
    rows = ledger.collect()
    for name, policy in rule_ledger.POLICIES.items():
        mask = rule_ledger.mask_of(policy)
        shown = {r.rule: r for r in rule_ledger.ablation(ledger, name).collect()}
        assert set(shown) == set(policy)
        for rule in policy:
            bit = rule_ledger.mask_of([rule])
            failing = [r.failed & mask for r in rows if r.failed & bit]
            assert shown[rule].failing == len(failing)
            assert shown[rule].failing_alone == sum(f == bit for f in failing)
            common = None
            for f in failing:
                common = f if common is None else common & f
            assert shown[rule].always_with == common
    ledger.unpersist()


@pytest.mark.parametrize("step", [line_dedup.drop_frequent_lines, line_dedup.without_frequent_lines, rule_ledger.judged])
def test_empty_table(spark, step):
    assert step(table(spark, [])).collect() == []


def test_digest_is_of_utf8(spark):
    row = line_dedup.drop_frequent_lines(table(spark, [(1, "é\nß")])).selectExpr("sha2(kept_text, 256) AS h").first()
    assert row.h == hashlib.sha256("é\nß".encode()).hexdigest()
