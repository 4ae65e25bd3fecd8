"""Grouping of rows whose values are gathered into arrays."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_HASHED = "spark.sql.execution.useObjectHashAggregateExec"


@contextmanager
def grouped_by_sorting(spark: SparkSession) -> Iterator[None]:
    """While this lasts, ``collect_list`` and the like are planned as aggregates over sorted rows.

    The hash aggregate gives up after a few groups and sorts its input then, before and after merging, and its result is
    sorted again when it is written. Aggregates over sorted rows share one sort, and it is the order they are written in.
    """
    before = spark.conf.get(_HASHED, "true")
    spark.conf.set(_HASHED, "false")
    try:
        yield
    finally:
        spark.conf.set(_HASHED, before)
