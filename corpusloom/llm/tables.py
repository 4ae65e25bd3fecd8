"""Reading test tables, and cutting lineage with tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.scratch import scratch_path
from ..session import ship_package

ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Executors can be lost at any time: a written table is not recomputed and needs no
    cached block.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def python_tasks(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Prepare a session for Arrow functions over texts.

    Texts can be long, so Python workers get ``rows`` rows at a time, not ten thousand.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def whole_text(column: str = "text"):
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))
