"""Quality rules as a ledger: every rule is evaluated once per document and its failure kept as one bit, beside the
measurements. Policies are versioned sets of bits; which documents a policy keeps, and what leaving a rule out would
change, follow from the bits alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import texts

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_marks", "n_distinct_words")
# The characters counted as symbols, and the marks that shout.
SYMBOLS, MARKS = b"#*$%&|<>", b"!?"

# A rule holds for a document when its expression over the measurements is true; the bit is set when it fails.
# Whole numbers only, so every engine gives the same bits. New rules go to the end: bits keep their meaning.
RULES: dict[str, str] = {
    "enough_words": "n_words >= 50",
    "few_repeated_windows": "100 * n_repeat_words <= 50 * n_words",
    "not_empty": "n_words >= 1",
    "words_not_short": "word_chars >= 2 * n_words",
    "words_not_long": "word_chars <= 14 * n_words",
    "few_symbols": "20 * n_symbols <= word_chars",
    "few_duplicate_lines": "10 * n_dup_lines <= 5 * n_lines",
    "not_shouted": "10 * n_upper_words <= 6 * n_words",
    "few_marks": "10 * n_marks <= 2 * n_words",
    "varied_words": "n_words < 20 or 20 * n_distinct_words >= n_words",
}
POLICIES: dict[str, Sequence[str]] = {
    "base-1": ("enough_words", "few_repeated_windows"),
    "prose-1": tuple(RULES),
}


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of each whole text; a null text has no words and one empty line.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``n_dup_lines``: lines with a word, equal to an earlier line.
    ``n_repeat_words``: words in a three-word window that occurs twice or more in the text, the first included.
    ``n_upper_words``: words with an A-Z and no a-z. ``n_marks``: characters of ``[!?]``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_measured(text or b"") for text in batch.column(1).to_pylist()]
            if rows:
                columns = [pa.array(list(column), pa.int64()) for column in zip(*rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *MEASURES])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{m} long" for m in MEASURES)
    return texts(docs).select("doc_id", F.encode("text", "utf-8").alias("text")).mapInArrow(run, schema)


def _measured(text: bytes) -> tuple[int, ...]:
    found = text.split()
    n = len(found)
    lines = text.split(b"\n")
    with_word = [line for line in lines if line.strip()]
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in found), np.int64, n)
    return (
        n,
        sum(map(_chars, numbers, np.bincount(ids, minlength=len(numbers)).tolist())),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(with_word) - len(set(with_word)),
        _in_repeated_windows(ids),
        len(lines),
        int(np.fromiter(map(bytes.isupper, numbers), bool, len(numbers))[ids].sum()) if n else 0,
        len(text) - len(text.translate(None, MARKS)),
        len(numbers),
    )


def _chars(word: bytes, times: int) -> int:
    return times * (len(word) if word.isascii() else len(word.decode()))


def _in_repeated_windows(ids: np.ndarray) -> int:
    if ids.size < 4:
        return 0
    window = np.unique(ids[:-2] * (ids.max() + 1) + ids[1:-1], return_inverse=True)[1] * (ids.max() + 1) + ids[2:]
    _, which, times = np.unique(window, return_inverse=True, return_counts=True)
    repeated = times[which] > 1
    covered = np.zeros(ids.size, bool)
    for shift in range(3):
        covered[shift : shift + repeated.size] |= repeated
    return int(covered.sum())


def mask_of(names: Sequence[str], rules: Mapping[str, str] = RULES) -> int:
    order = list(rules)
    return sum(1 << order.index(name) for name in set(names))


def ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """The measurements and ``failed``: bit ``k`` is set when rule ``k`` fails."""
    bits = [F.when(F.expr(rule), F.lit(0)).otherwise(F.lit(1 << k)).cast("long") for k, rule in enumerate(rules.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("failed", failed)


def fails(policy: str, rules: Mapping[str, str] = RULES, policies: Mapping[str, Sequence[str]] = POLICIES) -> Column:
    """Whether a ledger row fails a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(policies[policy], rules))) != 0


def judged(docs: DataFrame, policy: str = "prose-1", base: str = "base-1") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` (no rule of either policy failed), one row per row of ``docs``."""
    return ledger(docs).withColumns({"base_failed": fails(base), "kept": ~fails(base) & ~fails(policy)})


def ablation(ledgered: DataFrame, policy: str = "prose-1", rules: Mapping[str, str] = RULES, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (kept if the rule were left out), and the
    rules that failed in every one of its documents, as bits.

    Rows are first counted per pattern of bits, of which there are few; the rest works on the patterns.
    """
    mask = mask_of(policies[policy], rules)
    patterns = ledgered.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("docs"))
    names = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(mask_of([name], rules)).cast("long").alias("bit")) for name in policies[policy]])
    each = patterns.select("bits", "docs", F.explode(names).alias("r")).select("bits", "docs", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("docs"))), F.lit(0)).alias("failing"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("docs"))), F.lit(0)).alias("failing_alone"),
        F.bit_and(F.when(hit, F.col("bits"))).alias("always_with"),
    )
