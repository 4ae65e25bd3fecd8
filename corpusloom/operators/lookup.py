"""Index terms by pattern, by range and by edit distance, for tables of queries.

A stored lookup keeps two tables of the vocabulary, both sorted by their key:

``grams``     ``(field, gram, term, df)``: the runs of two and three characters of every term, its ends marked
``variants``  ``(field, variant, term, df)``: what is left of a term after up to two deletions. Two words within two
              edits, swaps of neighbours included, have a variant in common. Of terms of over ``SHORT`` characters it is what is
              left of each half after one deletion at most: one half has no more than one edit (a swap across the middle
              is a replacement in either), so that a term has two rows more than characters. Terms of over ``LONG``
              are cut into five pieces: two edits leave one piece whole, moved by two places at most.

With it a batch of patterns or words is an equality join, and only what meets there is compared.
Without it every pattern and word is tried on the whole vocabulary of its field.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.edits import edit_distance
from ..functions.patterns import lowered_pattern, regex_grams, wildcard_grams, wildcard_regex
from ..plans.joins import join_on_small
from .fields import FieldIndex

SHORT = 7
LONG = 24
PIECES = 5
EDITS = 2
LISTED = 1024


@dataclass(frozen=True)
class Lookup:
    grams: DataFrame
    gram_counts: DataFrame
    variants: DataFrame


def grams_of(term: Column) -> Column:
    """Distinct runs of two and three characters, between a mark for the start and one for the end."""
    marked = _marked(term)

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substr(marked, i, F.lit(n)))

    return F.array_distinct(F.concat(runs(2), runs(3)))


def _marked(term: Column) -> Column:
    return F.concat(F.lit("\x02"), term, F.lit("\x03"))


def _less_one(text: str) -> set[str]:
    """The text, and all that is left of it without one character."""
    return {text} | {text[:i] + text[i + 1 :] for i in range(len(text))}


def _less_two(text: str) -> set[str]:
    return {left for once in _less_one(text) for left in _less_one(once)}


def _half_keys(size: int, side: str, half: str) -> set[str]:
    return {f"{side}{size}\x02{left}" for left in _less_one(half)}


def _cuts(size: int) -> list[int]:
    return [size * k // PIECES for k in range(PIECES + 1)]


def _term_keys(term: str) -> set[str]:
    size, middle = len(term), len(term) // 2
    if size <= SHORT:
        return _less_two(term)
    if size <= LONG:
        return _half_keys(size, "<", term[:middle]) | _half_keys(size, ">", term[middle:])
    cuts = _cuts(size)
    return {f"{size}\x02{k}\x02{term[cuts[k] : cuts[k + 1]]}" for k in range(PIECES)}


def _word_keys(word: str) -> set[str]:
    own = len(word)
    keys = _less_two(word) if own - EDITS <= SHORT else set()
    for size in range(max(own - EDITS, SHORT + 1), own + EDITS + 1):
        if size <= LONG:
            first, last = size // 2, size - size // 2
            for width in range(-1, 2):
                if first + width <= own:
                    keys |= _half_keys(size, "<", word[: first + width])
                if last + width <= own:
                    keys |= _half_keys(size, ">", word[own - last - width :])
            continue
        cuts = _cuts(size)
        for k in range(PIECES):
            for begin in range(cuts[k] - EDITS, cuts[k] + EDITS + 1):
                width = cuts[k + 1] - cuts[k]
                if begin >= 0 and begin + width <= own:
                    keys.add(f"{size}\x02{k}\x02{word[begin : begin + width]}")
    return keys


def _keys(of):
    def column(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: list(of(text)) if text is not None else [])

    return F.pandas_udf(column, "array<string>")


def term_variants(term: Column) -> Column:
    """Keys under which a term is stored."""
    return _keys(_term_keys)(term)


def word_variants(word: Column) -> Column:
    """Keys that every term within two edits of ``word`` shares at least one of."""
    return _keys(_word_keys)(word)


def write_lookup(index: FieldIndex, path: str) -> Lookup:
    """Write the lookup of an index's vocabulary. It is as of now: write it again after documents are added."""
    terms = index.vocabulary.select("field", "term", "df")
    tables = {
        "grams": terms.select("field", F.explode(grams_of(F.col("term"))).alias("gram"), "term", "df"),
        "variants": terms.select("field", F.explode(term_variants(F.col("term"))).alias("variant"), "term", "df"),
    }
    for name, rows in tables.items():
        key = rows.columns[:3]
        rows.repartitionByRange(*key).sortWithinPartitions(*key).write.mode("overwrite").parquet(f"{path}/{name}")
    grams = index.vocabulary.sparkSession.read.parquet(f"{path}/grams")
    counts = grams.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("field", "gram").sortWithinPartitions("field", "gram").write.mode("overwrite").parquet(f"{path}/gram_counts")
    return open_lookup(index.vocabulary.sparkSession, path)


def open_lookup(spark: SparkSession, path: str) -> Lookup:
    return Lookup(*(spark.read.parquet(f"{path}/{name}") for name in ("grams", "gram_counts", "variants")))


def _met(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of a sorted table whose field and ``key`` are wanted; few keys are listed, so that row groups are skipped."""
    listed = wanted.select(key).distinct().limit(LISTED + 1).collect()
    if len(listed) <= LISTED:
        table = table.where(F.col(key).isin([row[key] for row in listed]))
    return join_on_small(table, wanted, ["field", key], salt_by=["term"])


_READ = "struct<regex:string,grams:array<string>>"


def _read_patterns(syntax: str):
    def read(pattern: str) -> dict:
        lowered = pattern.lower()
        if syntax == "wildcard":
            return {"regex": wildcard_regex(lowered), "grams": wildcard_grams(lowered)}
        return {"regex": rf"\A(?:{lowered_pattern(pattern)})\z", "grams": regex_grams(pattern)}

    def column(patterns: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(p) for p in patterns], columns=["regex", "grams"])

    return F.pandas_udf(column, _READ)


def terms_of_patterns(
    index: FieldIndex, patterns: DataFrame, lookup: Lookup | None = None, syntax: str = "wildcard"
) -> DataFrame:
    """``(key, field, term, df)`` of patterns ``(key, field, pattern)``: terms that match as a whole.

    ``syntax`` is ``wildcard`` or ``regex`` (Java). With a lookup a pattern looks at the terms that hold the rarest of the
    character runs it must have, and at the whole vocabulary of its field only if it has none of two, like ``*`` or ``[ab]?``.
    """
    if syntax not in ("wildcard", "regex"):
        raise ValueError(f"unknown pattern syntax {syntax!r}")
    read = patterns.select("key", "field", _read_patterns(syntax)(F.col("pattern")).alias("read"))
    read = read.select("key", "field", "read.regex", "read.grams")
    matches = F.expr("rlike(term, regex)")
    # Runs of a pattern are equally long. A single character is in too many terms to look them up.
    known = F.coalesce(F.length(F.get("grams", F.lit(0))), F.lit(0)) > 1
    free = read if lookup is None else read.where(~known)
    tried = join_on_small(index.vocabulary.select("field", "term", "df"), free.drop("grams"), ["field"], salt_by=["term"])
    found = tried.where(matches).select("key", "field", "term", "df")
    if lookup is None:
        return found
    bound = read.where(known).select("key", "field", "regex", "grams", F.explode("grams").alias("gram"))
    counts = _counted(lookup, bound)
    rarest = counts.groupBy("key", "field", "regex", "grams").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    # The other runs are looked for first: an expression is compiled anew for each pair.
    has_all = F.forall("grams", lambda gram: F.contains(_marked(F.col("term")), gram))
    held = _met(lookup.grams, rarest, "gram").where(has_all & matches).select("key", "field", "term", "df")
    return held.unionByName(found) if not free.isEmpty() else held


def _counted(lookup: Lookup, bound: DataFrame) -> DataFrame:
    wanted = bound.select("field", "gram").distinct()
    listed = wanted.select("gram").distinct().limit(LISTED + 1).collect()
    table = lookup.gram_counts
    if len(listed) <= LISTED:
        table = table.where(F.col("gram").isin([row["gram"] for row in listed]))
    return bound.join(table, ["field", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def terms_of_ranges(index: FieldIndex, ranges: DataFrame) -> DataFrame:
    """``(key, field, term, df)`` of ranges ``(key, field, low, high)`` in text order, both ends included, null ends open."""
    within = (F.col("low").isNull() | (F.col("term") >= F.col("low"))) & (F.col("high").isNull() | (F.col("term") <= F.col("high")))
    met = join_on_small(index.vocabulary.select("field", "term", "df"), ranges, ["field"], salt_by=["term"])
    return met.where(within).select("key", "field", "term", "df")


def _plain_edits_allow(term: Column, word: Column) -> Column:
    """Necessary test without Python: a swap of neighbours is two plain edits at most, and leaves the characters as they are."""

    def in_order(text: Column) -> Column:
        return F.array_join(F.sort_array(F.split(text, "")), "")

    plain = F.levenshtein(term, word, 2 * EDITS)
    one_swap = (plain == 3) & (F.levenshtein(in_order(term), in_order(word), 2) >= 0)
    return plain.between(0, 2) | one_swap | ((plain == 4) & (in_order(term) == in_order(word)))


def terms_within(index: FieldIndex, words: DataFrame, lookup: Lookup | None = None) -> DataFrame:
    """``(key, field, term, df, edits, similarity)`` of words ``(key, field, word, max_edits)``, at most two edits.

    Distances, similarity and the terms that count are those of ``similar_terms``.
    """
    words = words.withColumn("word", F.lower("word"))
    if lookup is None:
        met = join_on_small(index.vocabulary.select("field", "term", "df"), words, ["field"], salt_by=["term"])
    else:
        keyed = words.select("*", F.explode(word_variants(F.col("word"))).alias("variant"))
        met = _met(lookup.variants, keyed, "variant").select("key", "field", "term", "df", "word", "max_edits")
    close = met.where(_plain_edits_allow(F.col("term"), F.col("word")))
    if lookup is not None:
        close = close.distinct()  # a pair can have several variants in common
    measured = close.withColumn("edits", edit_distance(F.col("term"), F.col("word")))
    similarity = 1 - F.try_divide(F.col("edits"), F.least(F.length("term"), F.length("word")))
    return (
        measured.where(F.col("edits") <= F.col("max_edits"))
        .withColumn("similarity", similarity)
        .where(F.col("similarity") > 0)
        .select("key", "field", "term", "df", "edits", "similarity")
    )
