"""Where jobs put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow.fs import FileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """Folder of this application in the cluster's shared folder (``spark.checkpoint.dir``).

    Without that setting only a local session may proceed, with a temporary folder:
    on a cluster the executors would not share it.
    """
    application = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", "") or (
        spark.sparkContext.getCheckpointDir() or ""
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if application not in _LOCAL:
            _LOCAL[application] = tempfile.mkdtemp(prefix="corpusloom-")
        shared = _LOCAL[application]
    return f"{shared.rstrip('/')}/corpusloom-{application}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, under :func:`run_folder`."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new intermediate table and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """While this lasts, the shuffle files of a write are deleted as soon as it has ended.

    Otherwise they stay until the driver happens to collect its garbage, and steps that follow each other add up on disk.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once nothing reads them any more."""
    remove_table(spark, run_folder(spark))


def opened_for_writing(path: str):
    """An output stream for one file of a shared folder, given as a path or a URI."""
    located = path if "://" in path or path.startswith("file:") else f"file://{path}"
    system, place = FileSystem.from_uri(located)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return system.open_output_stream(place, compression=None)


def path_has_table(spark: SparkSession, path: str) -> bool:
    """Whether a finished parquet table can be opened at ``path``."""
    try:
        spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
