"""Text corpora as ``(doc_id, text)`` frames."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.joins import fits_broadcast
from ..plans.parallelism import spread_small_scan
from ..plans.ranking import dense_numbers
from ..plans.scratch import saved_table

#: Names listed at a time; files and bytes of a task that reads them, bytes it holds before it hands them on.
LISTED = 1 << 16
TASK_FILES = 1 << 14
TASK_BYTES = 128 << 20
HELD_BYTES = 8 << 20


def _file_name() -> Column:
    """Name of the file a row comes from; Spark reports it percent-encoded."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded).alias("doc_id")


def hidden_files(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder that Spark's readers pass over: leading ``_`` or ``.``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not (system.exists(folder) and system.getFileStatus(folder).isDirectory()):
        return []
    # Only such names come from the file system: a call to the JVM for each file of a large folder takes minutes.
    hidden = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "[_.]*"))
    files = [f.getPath().getName() for f in hidden if f.isFile()]
    return [n for n in files if n != "_SUCCESS" and not n.endswith(".crc")]


def _folder(spark: SparkSession, path: str) -> str | None:
    """The folder at ``path`` as Python workers open it; None if it is no folder or only Spark can open it."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    located = located.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(located).toUri()
    uri = located.toString() if located.getScheme() != "file" else f"file://{located.getPath()}"
    try:
        system, place = _opened(uri)
        return uri if system.get_file_info(place).type == FileType.Directory else None
    except (OSError, ValueError, pa.ArrowException):
        return None


def _opened(uri: str) -> tuple[FileSystem, str]:
    # A local path is no URI: its percent signs are as they are in the name.
    return (LocalFileSystem(), uri.removeprefix("file://")) if uri.startswith("file://") else FileSystem.from_uri(uri)


def _files(uri: str) -> Iterator[tuple[str, int]]:
    system, place = _opened(uri)
    if isinstance(system, LocalFileSystem):
        with os.scandir(place) as entries:
            yield from ((e.name, e.stat().st_size) for e in entries if e.is_file())
    else:
        found = system.get_file_info(FileSelector(place))
        yield from ((f.base_name, f.size) for f in found if f.type == FileType.File)


def _listing(spark: SparkSession, uri: str, suffix: str | None) -> DataFrame:
    """``(name, size)`` of the files of a folder, hidden ones too, listed by a task and written."""

    def listed(batches):
        for _ in batches:
            names, sizes = [], []
            for name, size in _files(uri):
                if name.endswith(suffix or "") and name != "_SUCCESS" and not name.endswith((".crc", "._COPYING_")):
                    names.append(name)
                    sizes.append(size)
                if len(names) == LISTED:
                    yield pa.RecordBatch.from_pydict({"name": names, "size": pa.array(sizes, pa.int64())})
                    names, sizes = [], []
            yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "size": pa.array(sizes, pa.int64())})

    return saved_table(spark.range(0, 1, 1, 1).mapInArrow(listed, "name string, size bigint"), "listing")


def _contents(files: DataFrame, uri: str) -> DataFrame:
    """``(doc_id, content)`` of the files of a listing."""

    def read(batches):
        system, place = _opened(uri)
        for batch in batches:
            names, held, size = [], [], 0
            for name in batch.column("name").to_pylist():
                with system.open_input_stream(f"{place}/{name}", compression=None) as source:
                    content = source.read()
                if names and size + len(content) > HELD_BYTES:
                    yield pa.RecordBatch.from_pydict({"doc_id": names, "content": pa.array(held, pa.binary())})
                    names, held, size = [], [], 0
                names.append(name)
                held.append(content)
                size += len(content)
            if names:
                yield pa.RecordBatch.from_pydict({"doc_id": names, "content": pa.array(held, pa.binary())})

    total = files.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, total["n"]), total["n"] // TASK_FILES, (total["size"] or 0) // TASK_BYTES, 1)
    return files.select("name").repartition(tasks).mapInArrow(read, "doc_id string, content binary")


def read_corpus(
    spark: SparkSession,
    path: str,
    suffix: str | None = None,
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """One row per file of a folder (not its subfolders); the file name is the id.

    ``suffix='.txt'`` keeps only names with that ending (case-sensitive). Line ends are
    normalised to ``\\n``. Files whose names start with ``_`` or ``.``, which Spark does not
    read, are refused. A file must fit in one row (2 GB); use :func:`read_corpus_lines` beyond.

    A folder is listed by a task and its names are written, so that the driver holds none of them however many files
    there are. Where Python workers can't open it Spark lists it, on the driver.
    """
    uri = _folder(spark, path)
    if uri:
        raw = _contents(_named(spark, uri, suffix), uri)
    else:
        hidden = [name for name in hidden_files(spark, path) if name.endswith(suffix or "")]
        _refuse(len(hidden), hidden[0] if hidden else None)
        reader = spark.read.format("binaryFile")
        if suffix:
            reader = reader.option("pathGlobFilter", f"*{suffix}")
        raw = reader.load(path).select(_file_name(), "content")
    return raw.select("doc_id", F.regexp_replace(F.decode("content", encoding), "\r\n?", "\n").alias("text"))


def _named(spark: SparkSession, uri: str, suffix: str | None) -> DataFrame:
    """``(name, size)`` of the files to read: those that aren't empty, as Spark's readers have it."""
    files = _listing(spark, uri, suffix)
    hidden = files.where(F.col("name").rlike(r"\A[_.]")).agg(F.count("*").alias("n"), F.min("name").alias("name")).first()
    _refuse(hidden["n"], hidden["name"])
    return files.where("size > 0")


def _refuse(n: int, name: str | None) -> None:
    if n:
        raise ValueError(f"{n} files that Spark does not read, such as {name!r}: rename them")


def file_names(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """``(doc_id)`` of :func:`read_corpus`, without reading the files."""
    uri = _folder(spark, path)
    if uri:
        return _named(spark, uri, suffix).select(F.col("name").alias("doc_id"))
    return read_corpus(spark, path, suffix).select("doc_id")


def numbered_files(docs: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``docs`` with the place of the file name in their order as a whole number ``doc_id``.

    First occurrences then sort and aggregate by number, in the order of the names. ``names`` are the ids of ``docs`` if
    they are known without reading them (:func:`file_names`).
    """
    numbers = dense_numbers((docs if names is None else names).select("doc_id"), "doc_id")
    hint = F.broadcast if fits_broadcast(numbers) else (lambda df: df)
    return docs.join(hint(numbers), "doc_id").select(F.col("number").alias("doc_id"), "text")


def from_table(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` of any table, read by enough tasks to use the session's cores."""
    return spread_small_scan(
        df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    )


def read_corpus_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``(doc_id, line_no, text)`` of text files of any size.

    Files are split over tasks. ``line_no`` grows with the place in the file but has
    gaps: it combines the split's offset with the row's place in the scan. Encodings other
    than UTF-8 must keep line ends as single bytes, as all of one byte do.
    """
    scan = spark.read.text(path)
    text = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        text = F.decode(text.cast("binary"), encoding)  # the scan keeps bytes as they are
    return scan.select(
        _file_name(),
        F.struct(
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_no"),
        text.alias("text"),
    )
