"""What the corpus operators share: the narrow input frame, intermediate tables, words and tokenizer files."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted
from ledgerline.session import scratch_path

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Within the block, a query's shuffle files go when the query ends, instead of with the driver's next full
    garbage collection. Only for queries whose result is written: nothing reads their shuffle files again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class Scratch:
    """Intermediate tables of one operator call, in the folder that all executors share."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label, self.places = spark, label, {}

    def table(self, df: DataFrame) -> DataFrame:
        """The rows written as Parquet and read back: lineage ends here, so a lost executor costs no more than
        the reading tasks."""
        path = scratch_path(self.spark, self.label)
        with shuffle_files_dropped(self.spark):
            df.write.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        self.places[id(read)] = (read, path)
        return read

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            _, path = self.places.pop(id(table))
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all tables of this call but these."""
        kept = {id(table) for table in tables}
        self.drop(*[table for key, (table, _) in list(self.places.items()) if key not in kept])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; whatever else the frame carries cannot clash with an operator's columns."""
    return docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))


def text_key(text: Column) -> Column:
    """64 bits of a text, null as empty. With ``doc_id`` it names a row; rows equal in both are interchangeable."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text, its ``n_chars`` to match, and its own columns in their order."""
    changes = {"text": text}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.length(F.coalesce(text, F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return docs.select(*[changes[c].alias(c) if c in changes else F.col(quoted(c)) for c in docs.columns])


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z as a-z; bytes methods know ASCII letters and spaces only."""
    return text.lower().split() if text else []


def tokenizer_file(name: str) -> str:
    """A path as it is; a bare name is looked up among the installed public tokenizers, on the machine that asks."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows at most, so that a task holds few of its texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What this worker keeps from task to task, made on first use. A worker outlives the operators that it works for, so
    it keeps one thing at a time."""
    if name not in _KEPT:
        forget()
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    """Let go of what another operator's tasks have kept in this worker."""
    _KEPT.clear()


class Memo(dict):
    """Values by key, made on first use. Two generations of ``most`` keys at most are kept, so a worker's memory
    stays bounded and what is used again survives; keys longer than ``longest`` are made each time."""

    def __init__(self, make: Callable, most: int = 200_000, longest: int = 200) -> None:
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
