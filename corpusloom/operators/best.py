"""The best hits of any-word queries without scoring every posting.

Documents are in blocks, and an index lists for every frequent term what a block's postings can score at most. Summed over a query's
words this bounds every document of a block. The blocks with the greatest bounds are scored first: their k-th best
score is a threshold that all blocks with a lower bound cannot reach, so their postings are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.scoring import bm25
from ..functions.text import drop_stop_words, words_standard
from ..plans.joins import fits_broadcast, join_on_small
from ..plans.ranking import top_k
from ..plans.scratch import scratch_path
from .fields import DOCUMENT, FieldIndex

LISTED = 1024
#: Scores are rounded for comparison: what is this close to the threshold is scored too.
SLACK = 1e-5


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _weighted(index: FieldIndex, field: str, queries: DataFrame, analyzer: Callable[[Column], Column]) -> DataFrame:
    """``(query_id, term, weight, df)`` of the query words that the index has."""
    words = queries.select("query_id", F.explode_outer(drop_stop_words(analyzer(F.col("text")))).alias("term"))
    wanted = words.where(F.col("term").isNotNull()).groupBy("query_id", "term").agg(F.count("*").alias("weight"))
    known = index.vocabulary.where(F.col("field") == field).select("term", "df")
    return _saved(join_on_small(known, wanted, ["term"], salt_by=["term"]), "query-words")


def _scored(index: FieldIndex, field: str, tf: str, length: str) -> Column:
    stats = index.stats(field)
    return F.col("weight") * bm25(F.col(tf), F.col(length), F.col("df"), stats["n_docs"], stats["avg_length"])


def _of_terms(rows: DataFrame, field: str, weighted: DataFrame) -> DataFrame:
    """Rows of the query words; few words are listed, so that row groups without them are skipped."""
    rows = rows.where(F.col("field") == field)
    terms = weighted.select("term").distinct().limit(LISTED + 1).collect()
    return rows.where(F.col("term").isin([r["term"] for r in terms])) if len(terms) <= LISTED else rows


def block_bounds(index: FieldIndex, field: str, weighted: DataFrame) -> DataFrame:
    """``(query_id, batch, block, bound)``: no document of the block scores more for the query.

    Frequent terms are bounded by their greatest frequency and shortest document in the block. The others have few
    postings in a batch, whose scores are taken as they are.
    """
    if index.blocks is None:
        raise ValueError("only a stored index has blocks")
    blocks = _of_terms(index.blocks, field, weighted).select("batch", "term", "block", "max_tf", "min_length")
    bounded = join_on_small(blocks, weighted, ["term"], salt_by=["block"]).select(
        "query_id", "batch", "block", "term", _scored(index, field, "max_tf", "min_length").alias("most")
    )
    listed = blocks.select("batch", "term").distinct()
    rare = _of_terms(index.postings, field, weighted).select("batch", "term", "block", "tf", "length")
    rare = rare.join(F.broadcast(listed) if fits_broadcast(listed) else listed, ["batch", "term"], "left_anti")
    seen = join_on_small(rare, weighted, ["term"], salt_by=["block"]).select(
        "query_id", "batch", "block", "term", _scored(index, field, "tf", "length").alias("score")
    )
    seen = seen.groupBy("query_id", "batch", "block", "term").agg(F.max("score").alias("most"))
    return bounded.unionByName(seen).groupBy("query_id", "batch", "block").agg(F.sum("most").alias("bound"))


def _in_blocks(index: FieldIndex, field: str, weighted: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(query_id, batch, doc_id, score)`` of all documents in blocks ``(query_id, batch, block)``."""
    postings = _of_terms(index.postings, field, weighted)
    numbers = blocks.select("block").distinct().limit(LISTED + 1).collect()
    if len(numbers) <= LISTED:
        postings = postings.where(F.col("block").isin([r["block"] for r in numbers]))
    asked = join_on_small(blocks, weighted, ["query_id"], salt_by=["block"])
    found = join_on_small(postings, asked, ["batch", "block", "term"], salt_by=["doc_id"])
    score = _scored(index, field, "tf", "length").alias("score")
    return found.select("query_id", *DOCUMENT, score).groupBy("query_id", *DOCUMENT).agg(F.sum("score").alias("score"))


def surviving_blocks(index: FieldIndex, field: str, weighted: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, batch, block)``: every block that can hold one of the ``k`` best hits of a query.

    A block has a hit at least, so the ``k`` blocks of the greatest bounds have ``k``, and the least of the best ``k`` scores in
    them is reached by at least ``k`` documents.
    """
    bounds = _saved(block_bounds(index, field, weighted), "block-bounds")
    greatest = Window.partitionBy("query_id").orderBy(F.desc("bound"), "batch", "block")
    first = bounds.withColumn("rank", F.row_number().over(greatest)).where(F.col("rank") <= k)
    scores = _in_blocks(index, field, weighted, _saved(first.select("query_id", "batch", "block"), "first-blocks"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    threshold = _saved(kth.select("query_id", F.col("score").alias("threshold")), "thresholds")
    placed = bounds.join(F.broadcast(threshold) if fits_broadcast(threshold) else threshold, "query_id", "left")
    reached = F.col("threshold").isNull() | (F.col("bound") >= F.col("threshold") - SLACK)
    return _saved(placed.where(reached).select("query_id", "batch", "block"), "blocks")


def best_hits_batch(
    index: FieldIndex, field: str, queries: DataFrame, k: int = 10, analyzer: Callable[[Column], Column] = words_standard
) -> DataFrame:
    """``(query_id, doc_id, score)``: hits of any-word queries ``(query_id, text)``, among them the ``k`` best of each.

    They are what ``any_words_batch`` gives, without the documents of blocks that cannot reach the ``k``-th score; cut
    them with ``top_k_per_query``. Ties with the ``k``-th are kept.
    """
    weighted = _weighted(index, field, queries, analyzer)
    blocks = surviving_blocks(index, field, weighted, k)
    return _in_blocks(index, field, weighted, blocks).select("query_id", "doc_id", "score")


def top_k_with_total(hits: DataFrame, k: int = 10) -> tuple[DataFrame, int]:
    """The ``k`` best hits and the number of all, from one pass over them."""
    seen = Observation()
    best = _saved(top_k(hits.observe(seen, F.count(F.lit(1)).alias("n_hits")), k), "best-hits")
    return best, seen.get["n_hits"]
