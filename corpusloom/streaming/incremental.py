"""Corpus folders read as streams.

The batch operators already work file by file and add results up. Here Structured
Streaming keeps the sums: n-gram counts as streaming state, index batches as appends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.fields import fields_of_columns, write_index, index_exists
from ..plans.parallelism import session_with

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def corpus_stream(
    spark: SparkSession,
    path: str,
    suffix: str | None = None,
    encoding: str = "ISO-8859-1",
    max_files: int | None = None,
) -> DataFrame:
    """``(doc_id, text)`` of the files of a folder, each read once when it appears."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    decoded = F.decode("content", encoding)
    return reader.load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("doc_id"),
        F.regexp_replace(decoded, "\r\n?", "\n").alias("text"),
    )


def state_on_disk(spark: SparkSession) -> SparkSession:
    """A session whose streams keep their state on the executors' disks, within a bounded part of memory.

    The default store holds all keys on the heap, and a vocabulary grows with the corpus.
    """
    return session_with(
        spark,
        spark__sql__streaming__stateStore__providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
        spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB=500,
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
    )


def index_stream(
    docs: DataFrame,
    path: str,
    to_fields: Callable[[DataFrame], DataFrame] = lambda d: fields_of_columns(
        d, "doc_id", text="text"
    ),
) -> DataStreamWriter:
    """Writer that appends every micro-batch to a stored index.

    Every micro-batch is listed with the id of its query, which a restart from the same
    checkpoint keeps, and its number there: one that is delivered again after a failure is
    not added twice, and other streams or earlier documents of the index are left alone.
    """

    def add(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            spark = batch.sparkSession
            stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            mode = "append" if index_exists(spark, path) else "create"
            write_index(to_fields(batch), path, mode, delivery=(stream, number))

    return docs.writeStream.foreachBatch(add)
