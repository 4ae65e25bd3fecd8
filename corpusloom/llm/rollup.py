"""Token totals by source, language and tokenizer version, maintained by signed changes.

A store is a folder: ``changes/<batch>-<attempt>/`` holds the summed changes of a batch,
``commits/<batch>`` names the attempt that counts. The commit file is created only if it
isn't there, so a batch that is sent again, or half written by a lost driver, changes nothing.
Totals are the sum over the committed attempts.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

KEYS = ["source", "lang", "tokenizer"]
_SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def inserts(counts: DataFrame) -> DataFrame:
    """Changes that add the documents of ``counts`` (the keys and ``n_tokens``)."""
    return counts.select(*KEYS, F.lit(1).alias("n_docs"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Changes that take the documents of ``counts`` away again."""
    return inserts(counts).select(*KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes for documents whose count or key changed: the old rows go, the new ones come."""
    return deletes(old).unionByName(inserts(new))


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _commits(spark: SparkSession, store: str) -> dict[str, str]:
    """Attempt of each committed batch: one small file for each batch."""
    system, folder = _folder(spark, f"{store}/commits")
    if not system.exists(folder):
        return {}
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    return dict(name.split("=", 1) for name in names if "=" in name)


def apply_batch(spark: SparkSession, store: str, batch: str, changes: DataFrame) -> bool:
    """Add a batch of signed changes; false, and no change, if it is in the store already.

    Changes are summed by key on the map side first, so a source with a third of all rows
    sends one row for each task. Null keys are keys of their own. A batch without changes
    is committed all the same.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError("a batch name has letters, digits, dot, line and underscore only")
    if batch in _commits(spark, store):
        return False
    attempt = uuid.uuid4().hex
    summed = changes.groupBy(*KEYS).agg(
        F.sum("n_docs").cast("bigint").alias("n_docs"), F.sum("n_tokens").cast("bigint").alias("n_tokens")
    )
    summed.write.parquet(f"{store}/changes/{batch}-{attempt}")
    # All writers of a batch race for one lock; who has it names the attempt.
    system, lock = _folder(spark, f"{store}/locks/{batch}")
    system.mkdirs(lock.getParent())
    try:
        system.create(lock, False).close()
    except Exception as error:
        if not system.exists(lock):
            raise
        if batch in _commits(spark, store):
            return False
        raise RuntimeError(f"batch {batch} is being committed elsewhere; see release()") from error
    system, commit = _folder(spark, f"{store}/commits/{batch}={attempt}")
    system.mkdirs(commit.getParent())
    system.create(commit, False).close()
    return True


def release(spark: SparkSession, store: str, batch: str) -> None:
    """Give up the lock of a driver that was lost while it committed ``batch``."""
    system, lock = _folder(spark, f"{store}/locks/{batch}")
    system.delete(lock, False)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """``(source, lang, tokenizer, n_docs, n_tokens)``; keys without documents are left out."""
    paths = [f"{store}/changes/{batch}-{attempt}" for batch, attempt in sorted(_commits(spark, store).items())]
    if not paths:
        return spark.createDataFrame([], _SCHEMA)
    held = spark.read.schema(_SCHEMA).parquet(*paths)
    summed = held.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return summed.where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))
