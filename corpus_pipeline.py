"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

Every stage takes the documents as a table and returns documents again, the last one their places in sequences. Between
stages the rows are written to the shared folder and read back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import chunk_dedup, jaccard_join, line_dedup, packing, quality_model
from ledgerline.llm.common import Scratch
from ledgerline.session import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; so do documents without a word."""
    return quality_model.good_documents(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from every document."""
    return line_dedup.without_frequent_lines(docs, min_documents=10)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, linked by a Jaccard similarity of 0.8 on five-word shingles, the document with
    the smallest id stays."""
    return jaccard_join.one_of_each_group(docs, size=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in a document with a smaller id, or earlier in the same one, go."""
    return chunk_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("best_fit_packing", pack),
]
# The classifier and the tokenizer cannot be written in SQL; tests compare run() with a plain form of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir))
        scratch.keep_only(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
