"""Two words within a distance of each other, for one query or a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.stemming import stem_words
from ..functions.text import words_clean
from ..plans.blocks import with_lookahead
from ..plans.joins import fits_broadcast, join_on_small

NEAR = 16


def _nearest_after(*partition: str, flag: str) -> Column:
    """Smallest later position where ``flag`` holds.

    The frame runs backwards over a descending order: Spark keeps a running minimum
    there, while a frame that ends at the last row would be recomputed for every row.
    """
    later = (
        Window.partitionBy(*partition)
        .orderBy(F.desc("pos"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.min(F.when(F.col(flag), F.col("pos"))).over(later)


def _matches(tagged: DataFrame, keys: list[str], ordered: bool) -> DataFrame:
    """Rows whose partner follows within ``max_dist``.

    ``tagged`` has ``keys``, ``pos``, ``max_dist`` and the flags ``is_first`` and
    ``is_second``. No pair of positions is ever produced.
    """
    placed = with_lookahead(tagged, F.col("max_dist"))
    group = [*keys, "block"]
    near = placed.select(
        "*",
        _nearest_after(*group, flag="is_second").alias("next_second"),
        _nearest_after(*group, flag="is_first").alias("next_first"),
    )
    reach = F.col("pos") + F.col("max_dist")
    forward = F.col("is_first") & (F.col("next_second") <= reach)
    backward = F.col("is_second") & (F.col("next_first") <= reach)
    hit = F.coalesce(forward, F.lit(False))
    if not ordered:
        hit = hit | F.coalesce(backward, F.lit(False))
    return near.where(F.col("own") & hit).select(*keys, "pos")


def _check_distance(max_dist: int) -> None:
    if isinstance(max_dist, bool) or not isinstance(max_dist, int) or max_dist < 0:
        raise ValueError(f"distance must be a whole number, not {max_dist!r}")


def proximity(
    tokens: DataFrame, first: str, second: str, max_dist: int = 1, ordered: bool = False
) -> DataFrame:
    """``(doc_id, pos)`` where one word is followed by the other within ``max_dist``.

    Either order counts and the smaller position is reported; distance 1 is the
    two-word phrase query. ``ordered=True`` asks for ``first`` before ``second``.
    ``tokens`` is a flat ``(doc_id, pos, term)`` frame; only the two words' rows are
    shuffled.
    """
    _check_distance(max_dist)
    tagged = tokens.where(F.col("term").isin(first, second)).select(
        "doc_id",
        "pos",
        F.lit(max_dist).alias("max_dist"),
        (F.col("term") == first).alias("is_first"),
        (F.col("term") == second).alias("is_second"),
    )
    return _matches(tagged, ["doc_id"], ordered)


def position_queries(queries: DataFrame) -> DataFrame:
    """``(query_id, w1, max_dist, w2)`` of texts ``word word`` or ``word /n word``.

    Texts are cleaned and stemmed as documents are; the slash is optional. Any other
    number of words, or a middle word that is no number, fails the job.
    """
    read = queries.select("query_id", "text", stem_words(words_clean(F.col("text"))).alias("w"))
    dist = F.when(F.size("w") == 2, F.lit(1)).when(
        F.size("w") == 3, F.replace(F.get("w", F.lit(1)), F.lit("/"), F.lit("")).try_cast("int")
    )
    refused = F.raise_error(F.concat(F.lit("not a position query: "), F.col("text")))
    return read.select(
        "query_id",
        F.get("w", F.lit(0)).alias("w1"),
        F.when(dist >= 0, dist).otherwise(refused.cast("int")).alias("max_dist"),
        F.get("w", F.size("w") - 1).alias("w2"),
    )


def proximity_batch(
    tokens: DataFrame, queries: DataFrame, ordered: bool = False
) -> DataFrame:
    """``(query_id, doc_id, pos)`` for every ``(query_id, w1, max_dist, w2)``.

    Each query becomes one row per distinct word, so tokens meet queries in an
    equi-join on the word. That makes a row for each query of a token's word. Where that is
    more than the largest distance, weighing words by their number of queries, tokens are paired with the few that follow
    instead, and meet queries by both words. Both ways return the same rows.
    """
    wanted = queries.where(F.col("max_dist") > 0)
    words = wanted.select("max_dist", F.explode(F.array("w1", "w2")).alias("word"))
    size = words.groupBy("word").agg(F.count("*").alias("n"), F.max("max_dist").alias("reach")).agg(
        F.max("reach").alias("reach"), (F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("queries")
    ).first()  # one row, from a job over the queries
    if size["reach"] is not None and size["reach"] <= min(NEAR, size["queries"]):
        return _paired(tokens, wanted, size["reach"], ordered)
    return _by_word(tokens, wanted, ordered)


def _paired(tokens: DataFrame, wanted: DataFrame, reach: int, ordered: bool) -> DataFrame:
    """Each token with those up to ``reach`` positions on, joined with the queries by both words."""
    words = wanted.select(F.explode(F.array("w1", "w2")).alias("term")).distinct()
    held = tokens.select("doc_id", "pos", "term")
    if fits_broadcast(words):
        held = held.join(F.broadcast(words), "term", "left_semi")
    placed = with_lookahead(held, reach)
    order = Window.partitionBy("doc_id", "block").orderBy("pos")
    following = [
        F.struct(F.lead("term", k).over(order).alias("t2"), (F.lead("pos", k).over(order) - F.col("pos")).alias("gap"))
        for k in range(1, reach + 1)
    ]
    near = placed.select("doc_id", "block", "pos", "own", F.col("term").alias("t1"), F.array(*following).alias("next"))
    pairs = near.where("own").select("doc_id", "block", "pos", "t1", F.inline("next")).where(F.col("gap") <= reach)
    ways = [F.struct(F.col("w1").alias("t1"), F.col("w2").alias("t2"))]
    if not ordered:
        ways.append(F.struct(F.col("w2").alias("t1"), F.col("w1").alias("t2")))
    asked = wanted.select("query_id", "max_dist", F.inline(F.array_distinct(F.array(*ways))))
    met = join_on_small(pairs, asked, ["t1", "t2"], salt_by=["doc_id", "pos"])
    close = met.where(F.col("gap") <= F.col("max_dist"))
    # A position is its own block's only. With the block among the keys, matches are told apart where the window put them.
    return close.select("query_id", "doc_id", "block", "pos").distinct().drop("block")


def _by_word(tokens: DataFrame, wanted: DataFrame, ordered: bool) -> DataFrame:
    def role(word: str, is_first: bool, is_second: bool) -> Column:
        return F.struct(
            F.col(word).alias("term"),
            F.lit(is_first).alias("is_first"),
            F.lit(is_second).alias("is_second"),
        )

    roles = F.when(F.col("w1") == F.col("w2"), F.array(role("w1", True, True))).otherwise(
        F.array(role("w1", True, False), role("w2", False, True))
    )
    asked = wanted.select("query_id", "max_dist", F.inline(roles))
    tagged = join_on_small(tokens, asked, ["term"], salt_by=["doc_id", "pos"])
    return _matches(tagged, ["query_id", "doc_id"], ordered)


def positions_per_document(matches: DataFrame, *keys: str) -> DataFrame:
    """``(doc_id, positions)``, ascending, from :func:`proximity` rows."""
    return matches.groupBy(*(keys or ("doc_id",))).agg(
        F.sort_array(F.collect_list("pos")).alias("positions")
    )
