"""Ranked n-gram counts kept while a corpus grows.

A micro-batch counts its own n-grams by a plain aggregate, which spills, and writes them as one table of increments: nothing
is held between micro-batches, so there is no streaming state to load, keep and store. Increments are added up into a base
table when they have become as large as it, so that what is written in all stays in proportion to
what is read, but for a logarithm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.text import words_alpha
from ..operators.frequency import Tokenizer, counts_from_ngrams, merge_counts, ngrams


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Complete folders ``name=number`` of a path."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [f.getPath().getName() for f in system.listStatus(root)]
    return sorted(
        int(n.removeprefix(f"{name}="))
        for n in names
        if n.startswith(f"{name}=") and system.exists(hadoop(root, f"{n}/_SUCCESS"))
    )


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None, int]:
    """The base table, the increments since, and the number of the last one."""
    merged = _numbers(spark, f"{path}/base", "upto")
    upto = merged[-1] if merged else -1
    later = [n for n in _numbers(spark, f"{path}/changes", "batch") if n > upto]
    base = spark.read.parquet(f"{path}/base/upto={upto}") if merged else None
    changes = spark.read.parquet(*[f"{path}/changes/batch={n}" for n in later]) if later else None
    return base, changes, later[-1] if later else upto


def running_counts(
    docs: DataFrame, n: int, path: str, tokenizer: Tokenizer = words_alpha
) -> DataStreamWriter:
    """Writer that keeps counts and first occurrences of the n-grams of a stream ``(doc_id, text)`` at ``path``.

    One stream writes to a path. A micro-batch that is delivered again writes the same table again; once it is in the base
    table, it is not added to it a second time.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        counts_from_ngrams(batch).write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
        base, changes, last = _parts(spark, path)
        if changes is not None and changes.count() >= (base.count() if base is not None else 0):
            together = [changes] if base is None else [base, changes]
            merge_counts(*together).write.mode("overwrite").parquet(f"{path}/base/upto={last}")

    return ngrams(docs, n, tokenizer).writeStream.foreachBatch(add)


def open_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(ngram, n, first)`` as of the last complete micro-batch; rank it with ``rank_by_count``."""
    base, changes, _ = _parts(spark, path)
    if base is None and changes is None:
        raise FileNotFoundError(f"no counts at {path}")
    if changes is None:
        return base
    return merge_counts(changes) if base is None else merge_counts(base, changes)
