"""Letter and n-gram frequency tables of a corpus, ranked two ways."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import explode_words, word_ngrams, words_alpha
from ..plans.blocks import with_lookahead
from ..plans.ranking import by_count, first_seen

PIECE = 4096

Tokenizer = Callable[[Column], Column]


def letter_counts(docs: DataFrame) -> DataFrame:
    """``(letter, n)`` for a..z, zeros included, case folded, over the raw text.

    Texts are cut into pieces before they are split into characters, which bounds the
    arrays however long a document is. The characters are counted where they are read:
    each task sends at most 26 rows.
    """
    pieces = F.regexp_extract_all(F.lower("text"), F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    characters = docs.select(F.explode(pieces).alias("piece")).select(
        F.explode(F.split("piece", "")).alias("letter")
    )
    counted = (
        characters.where(F.col("letter").between("a", "z"))
        .groupBy("letter")
        .agg(F.count("*").alias("n"))
    )
    first = F.ascii(F.lit("a"))
    alphabet = docs.sparkSession.range(26).select(F.char(F.col("id") + first).alias("letter"))
    # At most 26 rows on either side.
    return alphabet.join(F.broadcast(counted), "letter", "left").select(
        "letter", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def ngrams(docs: DataFrame, n: int, tokenizer: Tokenizer = words_alpha, *keep: str) -> DataFrame:
    """One row per n-gram occurrence: ``(doc_id, *keep, pos, ngram)``."""
    words = docs.select("doc_id", *keep, tokenizer(F.col("text")).alias("words"))
    return explode_words(words, word_ngrams(F.col("words"), n), "doc_id", *keep, term="ngram")


def ngram_counts(
    docs: DataFrame, n: int, tokenizer: Tokenizer = words_alpha, by: tuple[str, ...] = ()
) -> DataFrame:
    """``(*by, ngram, n)``; n-grams never cross documents."""
    return ngrams(docs, n, tokenizer, *by).groupBy(*by, "ngram").agg(F.count("*").alias("n"))


def counts_from_ngrams(occurrences: DataFrame) -> DataFrame:
    """``(ngram, n, first)``: count and first occurrence of every n-gram."""
    seen = first_seen(
        F.col("doc_id"), F.col("pos"), occurrences.schema["doc_id"].dataType
    )
    return occurrences.groupBy("ngram").agg(
        F.count("*").alias("n"), seen.alias("first")
    )


def rank_alphabetical(counts: DataFrame) -> DataFrame:
    """Code-point order of the n-gram."""
    return counts.orderBy("ngram")


def rank_by_count(counts: DataFrame) -> DataFrame:
    """Most frequent first; equal counts in order of first occurrence."""
    return by_count(counts)


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Multiset sum of count tables (``ngram``, ``n`` and, if present, ``first``)."""
    together = reduce(DataFrame.unionByName, parts)
    totals = [F.sum("n").alias("n")]
    if "first" in together.columns:
        totals.append(F.min("first").alias("first"))
    return together.groupBy("ngram").agg(*totals)


def ngrams_of_positions(tokens: DataFrame, n: int) -> DataFrame:
    """N-grams of a flat ``(doc_id, pos, term)`` frame with gapless positions.

    For documents too long for one row. Windows run inside position blocks that overlap
    by ``n - 1``, so no task holds a whole document.
    """
    placed = with_lookahead(tokens, n - 1)
    slots = [F.col("term")]
    order = Window.partitionBy("doc_id", "block").orderBy("pos")
    slots += [F.lead("term", k).over(order) for k in range(1, n)]
    complete = placed.select(
        "doc_id", "pos", "own", F.concat(*_spaced(slots)).alias("ngram")
    )
    return complete.where(F.col("own") & F.col("ngram").isNotNull()).drop("own")


def _spaced(slots: list[Column]) -> list[Column]:
    spaced = [slots[0]]
    for slot in slots[1:]:
        spaced += [F.lit(" "), slot]
    return spaced
