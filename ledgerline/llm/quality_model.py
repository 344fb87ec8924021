"""Quality classifier without hand labels: overlapping heuristic labellers vote, expectation-maximisation estimates how
far each can be trusted, and the posterior labels train a hashed linear scorer that judges every document.

Votes are counted per pattern over all documents (three values per labeller, so their number is bounded), and the
estimation runs on these counts. The scorer is fitted on a bounded sample, ``sample`` documents at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted
from ledgerline.llm.common import Memo, forget, sliced, texts

DIMS = 1 << 12
BAD, GOOD, ABSTAIN = 0, 1, 2
_SYMBOLS, _MARKS = b"#*$%&|<>=_~^+{}[]\\", b"!?"
_LETTER = bytes(range(97, 123))
_SHAPE = bytes(97 if c in _LETTER or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))


def _word_bits(word: bytes) -> int:
    """A word's hash, shape bucket, length, symbols, marks and flags in one 64-bit number."""
    import xxhash

    shape = bytearray()
    for char in word.translate(_SHAPE):
        if not shape or shape[-1] != char:
            shape.append(char)
    symbols = len(word) - len(word.translate(None, _SYMBOLS))
    marks = len(word) - len(word.translate(None, _MARKS))
    plain = len(word) <= 3 and word.isalpha()
    bits = xxhash.xxh3_64_intdigest(word) >> 34
    for value, width in (
        (xxhash.xxh3_64_intdigest(bytes(shape)) % DIMS, 12),
        (min(len(word.decode("utf-8", "replace")), 63), 6),
        (min(symbols, 31), 5),
        (min(marks, 31), 5),
        (word.isupper(), 1),
        (plain, 1),
    ):
        bits = bits << width | int(value)
    return bits


def _read(text: bytes | None, memo: Memo) -> np.ndarray:
    found = text.split() if text else []
    return np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))


def _field(bits: np.ndarray, at: int, width: int) -> np.ndarray:
    return (bits >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)


def _shares(bits: np.ndarray) -> dict[str, float]:
    """What the labellers look at; of a text with words."""
    n = bits.size
    chars = max(1, int(_field(bits, 12, 6).sum()))
    return {
        "symbols": _field(bits, 7, 5).sum() / chars,
        "marks": _field(bits, 2, 5).sum() / n,
        "upper": _field(bits, 1, 1).sum() / n,
        "short": _field(bits, 0, 1).sum() / n,
        "distinct": np.unique(bits).size / n,
        "again": int((bits[1:] == bits[:-1]).sum()) / n,
        "length": chars / n,
        "words": n,
    }


# Each labeller: the share it looks at, and from where it votes bad and good; between the two it abstains.
LABELLERS: tuple[tuple[str, str, float, float], ...] = (
    ("symbols", "above", 0.05, 0.01),
    ("marks", "above", 0.3, 0.1),
    ("upper", "above", 0.6, 0.25),
    ("distinct", "below", 0.15, 0.35),
    ("again", "above", 0.25, 0.05),
    ("short", "below", 0.02, 0.08),
    ("length", "above", 9.0, 6.5),
    ("words", "below", 2, 20),
)


# The labellers that each look for one way of being bad.
_NEED_WORDS = ("short", "length")  # shares that say nothing in a text of a few words
ANCHORS = ("symbols", "marks", "upper", "distinct", "again")


def votes(bits: np.ndarray) -> int:
    """All votes as one number in base 3. A text without words is bad to all."""
    if not bits.size:
        return 0
    shares, pattern = _shares(bits), 0
    for k, (name, side, bad, good) in enumerate(LABELLERS):
        sign = 1 if side == "above" else -1
        value = sign * shares[name]
        vote = BAD if value > sign * bad else GOOD if value <= sign * good else ABSTAIN
        if name in _NEED_WORDS and bits.size < 20:
            vote = ABSTAIN
        pattern += vote * 3**k
    return pattern


def _features(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights: shares of word shapes, and of words that repeat, each hashed to a bucket."""
    n = bits.size
    shape = _field(bits, 18, 12)
    again = (bits[1:] == bits[:-1]).sum() / n
    extra = np.array([1, 2, 3]), np.array([1.0, 3 * again, 3 * (1 - np.unique(bits).size / n)])
    buckets, counts = np.unique(shape, return_counts=True)
    return np.concatenate((buckets, extra[0])), np.concatenate((np.sqrt(counts / n), extra[1]))


@dataclass
class Model:
    accuracy: np.ndarray  # labeller, class, vote; 1 where the vote is to abstain
    prior: np.ndarray  # share of each class; the last is the good one
    weights: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """How likely a document with these votes is good."""
        return _posterior(patterns, self.accuracy, self.prior)[:, -1]

    def score(self, bits: np.ndarray) -> float:
        if not bits.size:
            return 0.0
        buckets, values = _features(bits)
        return float(1 / (1 + np.exp(-np.clip((self.weights[buckets] * values).sum(), -30, 30))))


def _digits(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def _posterior(patterns: np.ndarray, accuracy: np.ndarray, prior: np.ndarray) -> np.ndarray:
    digits = _digits(patterns)
    like = np.log(accuracy[np.arange(len(LABELLERS))[:, None], :, digits.T]).sum(0) + np.log(prior)
    like = np.exp(like - like.max(1, keepdims=True))
    return like / like.sum(1, keepdims=True)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Vote probabilities by labeller, class and vote, and the classes' shares, from pattern counts.

    Bad documents are bad in different ways, and a labeller that looks for one way finds the others good; so there is
    one bad class per anchor labeller, which votes bad on most of its own class and on few good documents. Within
    these bounds all probabilities are estimated, the other labellers' on every class. A few made-up votes are added
    in each round, so a class or vote that no document shows keeps its meaning.
    """
    classes = len(ANCHORS) + 1
    names = [name for name, *_ in LABELLERS]
    anchored = [names.index(name) for name in ANCHORS]
    start = np.ones((len(LABELLERS), classes, 3))  # an abstention says nothing: its factor is 1 for every class
    voted = [BAD, GOOD]
    start[:, -1, voted], start[:, :-1, voted] = [0.05, 0.95], [0.4, 0.6]
    for k, labeller in enumerate(anchored):
        start[labeller, k, voted] = [0.95, 0.05]
        start[labeller, -1, voted] = [0.02, 0.98]
    first = np.full(classes, 0.1 / len(ANCHORS))
    first[-1] = 0.9
    accuracy, prior, digits, added = start, first, _digits(patterns), 5.0
    for _ in range(rounds):
        weight = _posterior(patterns, accuracy, prior).T * counts
        accuracy = added * start
        for vote in voted:
            accuracy[:, :, vote] += ((digits == vote).T[:, None, :] * weight).sum(2)
        accuracy[:, :, voted] /= accuracy[:, :, voted].sum(2, keepdims=True)
        accuracy[:, :, ABSTAIN] = 1
        for k, labeller in enumerate(anchored):
            for of, low, high in ((k, 0.8, 1.0), (classes - 1, 0.0, 0.1)):
                bad = min(max(accuracy[labeller, of, BAD], low), high)
                accuracy[labeller, of, voted] = [bad, 1 - bad]
        accuracy = np.clip(accuracy, 1e-6, None)
        prior = (weight.sum(1) + added * first) / (counts.sum() + added)
    return accuracy, prior


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Logistic weights for soft labels by accelerated gradient steps."""
    weights = np.zeros(DIMS)
    if not rows:
        return weights
    row = np.repeat(np.arange(len(rows)), [r[0].size for r in rows])
    bucket, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    label = np.array([r[2] for r in rows])
    step = 4 / float(np.bincount(row, value**2, len(rows)).mean() + ridge)
    ahead, momentum = weights.copy(), 1.0
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * ahead[bucket], len(rows)), -30, 30)))
        slope = np.bincount(bucket, value * ((guess - label) / len(rows))[row], DIMS) + ridge * ahead
        new, faster = ahead - step * slope, (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / faster * (new - weights)
        weights, momentum = new, faster
    return weights


def _narrow(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.encode("text", "utf-8").alias("text"))


def train(docs: DataFrame, sample: int = 8_000) -> Model:
    """The model of a table: labeller accuracies from all documents, the scorer from ``sample`` of them at most,
    drawn by a hash of the text, so that the draw does not depend on the order of rows."""

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        memo = Memo(_word_bits)
        for batch in sliced(batches):
            found = [votes(_read(text, memo)) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["pattern"])

    narrow = _narrow(docs)
    cast_votes = narrow.select("text").mapInArrow(cast, "pattern long")
    counted = cast_votes.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** labellers rows
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    counts = np.array([r["n"] for r in counted], float)
    accuracy, prior = estimate(patterns, counts)
    model = Model(accuracy, prior, np.zeros(DIMS))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        memo = Memo(_word_bits)
        for batch in sliced(batches):
            found = [bits for text in batch.column(0).to_pylist() if (bits := _read(text, memo)).size]
            made = [_features(bits) for bits in found]
            label = model.posterior(np.array([votes(bits) for bits in found], np.int64)) if found else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([m[0] for m in made], pa.list_(pa.int32())),
                    pa.array([m[1] for m in made], pa.list_(pa.float64())),
                    pa.array(label, pa.float64()),
                ],
                ["buckets", "shares", "label"],
            )

    grid = 1 << 20
    share = min(grid, int(grid * 0.9 * sample / max(1.0, counts.sum())) + 1)
    drawn = narrow.filter(F.pmod(F.xxhash64("text"), F.lit(grid)) < share).select("text")
    drawn = drawn.mapInArrow(featured, "buckets array<int>, shares array<double>, label double").limit(sample).collect()
    model.weights = fit_scorer([(np.array(r["buckets"], int), np.array(r["shares"]), r["label"]) for r in drawn])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, weak_label, score, kept``, one row per row of ``docs``. A text without words scores 0 and
    is rejected; whatever is not more likely bad than good is kept."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        memo = Memo(_word_bits)
        for batch in sliced(batches):
            found = [_read(text, memo) for text in batch.column(1).to_pylist()]
            if found:
                label = model.posterior(np.array([votes(bits) for bits in found], np.int64))
                scores = np.array([model.score(bits) for bits in found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(label), pa.array(scores), pa.array(scores >= 0.5)],
                    ["doc_id", "weak_label", "score", "kept"],
                )

    return _narrow(docs).mapInArrow(run, f"doc_id {id_type}, weak_label double, score double, kept boolean")


def classify(docs: DataFrame, sample: int = 8_000) -> DataFrame:
    """Train on ``docs`` and score them: ``doc_id, weak_label, score, kept``."""
    return score(docs, train(docs, sample))


def good_documents(docs: DataFrame, sample: int = 8_000) -> DataFrame:
    """``docs`` without the documents that the classifier rejects, as they are."""
    model = train(docs, sample)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        memo = Memo(_word_bits)
        for batch in sliced(batches):
            raw = batch.column("text").cast(pa.binary())
            good = [model.score(_read(text, memo)) >= 0.5 for text in raw.to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.select(*[quoted(c) for c in docs.columns]).mapInArrow(keep, docs.schema)
