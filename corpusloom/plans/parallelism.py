"""Task counts of scans: more for few splits, fewer for many small files; sessions with settings of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Repartition only when the scan yields fewer tasks than there are cores.

    Tokenizing is CPU bound, and a file with a single row group is read by a single
    task. Inputs with enough splits, which is every large one, are returned untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def session_with(spark: SparkSession, **settings: object) -> SparkSession:
    """A new session with the SQL settings of ``spark`` but for those given, two underscores for each dot."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in settings.items():
        session.conf.set(name.replace("__", "."), str(value))
    return session
