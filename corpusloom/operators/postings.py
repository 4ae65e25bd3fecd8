"""Positional inverted index: tokens, postings, lookups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.stemming import porter, stem_words
from ..functions.text import explode_words, words_clean
from ..plans.blocks import BLOCK, block_of
from ..plans.grouping import grouped_by_sorting
from ..plans.scratch import path_has_table, shuffles_dropped


STEM_PIECE = 1024


def clean_stems(text: Column) -> Column:
    """The index tokenizer: cleaned words, stemmed."""
    return stem_words(words_clean(text))


def positioned_tokens(
    docs: DataFrame,
    tokenizer: Callable[[Column], Column] = words_clean,
    stemmed: bool = True,
) -> DataFrame:
    """``(doc_id, pos, term)`` with 1-based positions.

    Stems are computed over pieces of at most :data:`STEM_PIECE` words, which bounds the
    Arrow batches however long the documents are.
    """
    words = docs.where(F.col("text").isNotNull()).select(
        "doc_id", tokenizer(F.col("text")).alias("words")
    )
    if not stemmed:
        return explode_words(words, F.col("words"), "doc_id")
    starts = F.sequence(F.lit(1), F.size("words") + 1, F.lit(STEM_PIECE))
    pieces = F.transform(starts, lambda start: F.slice("words", start, STEM_PIECE))
    stems = words.select("doc_id", F.posexplode(pieces).alias("piece", "words")).select(
        "doc_id", "piece", stem_words(F.col("words")).alias("words")
    )
    exploded = stems.select("doc_id", "piece", F.posexplode_outer("words").alias("at", "term"))
    return exploded.where(F.col("term").isNotNull()).select(
        "doc_id", (F.col("piece") * STEM_PIECE + F.col("at") + 1).alias("pos"), "term"
    )


def by_document(docs: DataFrame) -> DataFrame:
    """``docs`` with all rows of a document in one task: postings of their tokens are grouped there without a shuffle.

    What is moved are texts, which take a fraction of the bytes of their positioned tokens.
    """
    return docs.repartition("doc_id")


def position_lines(
    lines: DataFrame, tokenizer: Callable[[Column], Column], lines_per_block: int = BLOCK
) -> DataFrame:
    """``(doc_id, pos, term)`` of ``(doc_id, line_no, text)``, numbered over all lines.

    A line's first position is the token count of all earlier lines of its document.
    It is summed in two levels, inside scan splits and then over one row per split, so
    that no task handles a whole document.
    """
    counted = lines.select(
        "doc_id",
        F.col("line_no.split").alias("split"),
        F.col("line_no.row").alias("row"),
        tokenizer(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    chunk = F.floor(F.pmod(F.col("row"), F.lit(1 << 33)) / F.lit(lines_per_block))
    counted = counted.withColumn("chunk", chunk)
    earlier_chunks = (
        Window.partitionBy("doc_id")
        .orderBy("split", "chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        counted.groupBy("doc_id", "split", "chunk")
        .agg(F.sum(F.size("words")).alias("words_in_chunk"))
        .select(
            "doc_id",
            "split",
            "chunk",
            F.coalesce(F.sum("words_in_chunk").over(earlier_chunks), F.lit(0)).alias("base"),
        )
    )
    earlier_lines = (
        Window.partitionBy("doc_id", "split", "chunk")
        .orderBy("row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = counted.withColumn(
        "within", F.coalesce(F.sum(F.size("words")).over(earlier_lines), F.lit(0))
    ).join(offsets, ["doc_id", "split", "chunk"])
    return placed.select(
        "doc_id", "base", "within", F.posexplode_outer("words").alias("at", "term")
    ).select("doc_id", (F.col("base") + F.col("within") + F.col("at") + 1).alias("pos"), "term")


def build_postings(tokens: DataFrame, by_block: bool = False) -> DataFrame:
    """``(term, doc_id, positions, tf)``; ``positions`` ascending.

    The positions of a term are no larger than the row the document's text came in. For
    documents numbered over many rows (:func:`position_lines`) use ``by_block=True``: a
    posting then covers one ``block`` of 65,536 positions, so that a frequent term in a
    very long document is spread over rows and tasks.
    """
    keys = ["term", "doc_id"]
    if by_block:
        if "block" not in tokens.columns:
            tokens = tokens.withColumn("block", block_of(F.col("pos")))
        keys.append("block")
    return tokens.groupBy(*keys).agg(
        F.sort_array(F.collect_list("pos")).alias("positions"),
        F.count("*").cast("int").alias("tf"),
    )


def _whole_documents(postings: DataFrame) -> DataFrame:
    """``(term, doc_id, tf)`` with the blocks of a document, if any, added up."""
    if "block" not in postings.columns:
        return postings.select("term", "doc_id", F.col("tf").cast("bigint").alias("tf"))
    return postings.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf"))


def postings_positions(postings: DataFrame) -> DataFrame:
    """Back to the flat ``(doc_id, pos, term)`` form."""
    return postings.select("doc_id", F.explode_outer("positions").alias("pos"), "term")


def postings_summary(postings: DataFrame) -> DataFrame:
    """``(term, df, total)``: documents with the term and its occurrences."""
    return (
        _whole_documents(postings)
        .groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    )


def term_lookup(postings: DataFrame, term: str) -> DataFrame:
    """``(doc_id, tf)`` of the documents that hold an (already stemmed) term."""
    return _whole_documents(postings.where(F.col("term") == term)).select("doc_id", "tf")


def query_terms(spark: SparkSession, text: str) -> list[str]:
    """Clean and stem one query text exactly as documents are."""
    literal = spark.sql("SELECT 1").select(words_clean(F.lit(text)).alias("words"))
    return [porter(word) for word in literal.first()["words"]]


def save_postings(
    tokens: DataFrame, path: str, by_block: bool = False, mode: str = "overwrite"
) -> None:
    """Build postings and write them ordered by term, so that a term filter skips files.

    Tokens are range partitioned on term and document once; grouping and ordering then
    happen inside each range without a second shuffle. A term that is in every document
    fills many ranges.
    """
    if by_block:
        tokens = tokens.withColumn("block", block_of(F.col("pos")))
    keys = [key for key in ("term", "doc_id", "block") if key in tokens.columns]
    ranged = tokens.repartitionByRange(*keys)
    with grouped_by_sorting(tokens.sparkSession), shuffles_dropped(tokens.sparkSession):
        build_postings(ranged, by_block).sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def load_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ensure_postings(
    spark: SparkSession, path: str, tokens: Callable[[], DataFrame], by_block: bool = False
) -> DataFrame:
    """Load the saved postings, building and saving them first if there are none."""
    if not path_has_table(spark, path):
        save_postings(tokens(), path, by_block)
    return load_postings(spark, path)


def dump_postings(postings: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Readable copy, one JSON object per posting; ``compression="gzip"`` takes a seventh of the disk."""
    with grouped_by_sorting(postings.sparkSession), shuffles_dropped(postings.sparkSession):
        postings.write.mode(mode).option("compression", compression).json(path)
