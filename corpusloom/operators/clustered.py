"""Postings clustered by document, so that batches of queries score documents where their postings lie."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from ..plans.scratch import scratch_path
from .fields import FieldIndex

BUCKETS = 64
#: Postings to a bucket, where the number of buckets asked for would hold more.
BUCKET_ROWS = 1_000_000


def cluster_postings(index: FieldIndex, buckets: int = BUCKETS, path: str | None = None, name: str | None = None) -> FieldIndex:
    """``index`` with its postings written as a table of ``buckets`` buckets by document, sorted by term within.

    There are as many times more buckets as keep one within :data:`BUCKET_ROWS` postings, on average: a task has a bucket.

    Whatever is gathered for each document of a query then needs no shuffle of postings: a join with broadcast query
    words stays in its bucket, as does the aggregate over it. Documents are spread evenly whatever the terms, so a word in
    every document is in all buckets alike. Term filters still skip row groups. The table ``name`` is made new in
    the session's catalog, its files are at ``path``; it is as of now, like any table written.
    """
    spark: SparkSession = index.postings.sparkSession
    name = name or f"postings_{uuid.uuid4().hex}"
    buckets *= max(1, -(-index.postings.count() // (BUCKET_ROWS * buckets)))
    writer = index.postings.repartition(buckets, "doc_id").write.bucketBy(buckets, "doc_id").sortBy("field", "term")
    writer.option("path", path or scratch_path(spark, "clustered")).saveAsTable(name)
    return replace(index, postings=spark.table(name), clustered=True)
