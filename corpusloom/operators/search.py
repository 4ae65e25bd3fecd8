"""Search operators over a :class:`~corpusloom.operators.fields.FieldIndex`.

Every operator returns all hits as ``(doc_id, score)``, one row per document; cut them
with :func:`~corpusloom.plans.ranking.top_k` and count them with :func:`total_hits`.
Scores of pattern and range queries are the constant 1.

Query words come as arguments; :mod:`~corpusloom.operators.query_texts` reads query strings. ``term`` queries and patterns are
lowercased and matched against index terms as they are; the words of boolean, phrase
and disjunction queries go through the analyzer first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.edits import could_be_within, edit_distance
from ..functions.patterns import lowered_pattern, wildcard_regex
from ..functions.scoring import bm25, bm25_idf, bm25_tf
from ..functions.text import STOP_WORDS, drop_stop_words, words_standard
from ..plans.joins import fits_broadcast, join_on_small
from ..plans.scratch import saved_table
from .fields import DOCUMENT, FieldIndex

MAX_LISTED_TERMS = 1024
#: Rows of a batch, one for each posting and query with its word, that a task adds up.
BATCH_ROWS = 1_000_000


# --- helpers ------------------------------------------------------------------------
def _hits(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.col("score").cast("double").alias("score"))


def _of_field(index: FieldIndex, field: str) -> DataFrame:
    return index.postings.where(F.col("field") == field)


def _analyze(
    index: FieldIndex, text: str | Iterable[str], analyzer: Callable[[Column], Column]
) -> list[tuple[int, str]]:
    """``(offset, term)`` of one query text, by the analyzer the documents went through.

    A projection of literals: Spark folds it, no job runs.
    """
    joined = text if isinstance(text, str) else " ".join(text)
    spark = index.postings.sparkSession
    literal = spark.sql("SELECT 1").select(analyzer(F.lit(joined)).alias("words"))
    return [(i, w) for i, w in enumerate(literal.first()["words"]) if w not in STOP_WORDS]


def _document_frequencies(index: FieldIndex, field: str, terms: Iterable[str]) -> Column:
    """``map<term, df>`` of a few query terms, as one scalar subquery.

    A stored index reads its vocabulary. A lazy one counts the same filtered postings
    the query reads, so that both share one shuffle.
    """
    wanted = (F.col("field") == field) & F.col("term").isin(list(terms))
    if index.saved:
        counts = index.vocabulary.where(wanted).select("term", "df")
    else:
        counts = (
            index.postings.where(wanted)
            .groupBy("term")
            .agg(F.sum(F.when(F.col("tf") > 0, 1).otherwise(0)).alias("df"))
        )
    pairs = F.collect_list(F.struct("term", "df"))
    return counts.agg(F.map_from_entries(pairs)).scalar()


def _term_scores(index: FieldIndex, field: str, terms: Sequence[str]) -> DataFrame:
    """``(doc_id, term, score)`` for each posting of the query terms."""
    df = _document_frequencies(index, field, terms)
    stats = index.stats(field)
    score = bm25(
        F.col("tf"),
        F.col("length"),
        F.try_element_at(df, F.col("term")),
        stats["n_docs"],
        stats["avg_length"],
    )
    found = _of_field(index, field).where(F.col("term").isin(list(terms)))
    return found.select(*DOCUMENT, "term", score.alias("score"))


def _constant(rows: DataFrame) -> DataFrame:
    return rows.select(*DOCUMENT).distinct().select("doc_id", F.lit(1.0).alias("score"))


def _matching_terms(index: FieldIndex, field: str, matches: Column) -> DataFrame:
    """Postings whose term satisfies a predicate that parquet cannot evaluate.

    On a stored index the predicate runs over the vocabulary first. If few terms match
    they are listed in the postings filter, which then skips row groups; otherwise, and
    on a lazy index, the predicate is applied to the postings themselves.
    """
    postings = _of_field(index, field)
    if index.saved:
        terms = (
            index.vocabulary.where((F.col("field") == field) & matches)
            .select("term")
            .limit(MAX_LISTED_TERMS + 1)
            .collect()
        )
        if len(terms) <= MAX_LISTED_TERMS:
            return postings.where(F.col("term").isin([row["term"] for row in terms]))
    return postings.where(matches)


# --- single terms, ranges and patterns ------------------------------------------------
def match_all(index: FieldIndex) -> DataFrame:
    return index.docs.select("doc_id", F.lit(1.0).alias("score"))


def term_search(index: FieldIndex, field: str, term: str) -> DataFrame:
    """Documents with an exact index term, scored by BM25."""
    return _hits(_term_scores(index, field, [term.lower()]))


def prefix_search(index: FieldIndex, field: str, prefix: str) -> DataFrame:
    return _constant(_of_field(index, field).where(F.col("term").startswith(prefix.lower())))


def range_search(index: FieldIndex, field: str, low: str, high: str) -> DataFrame:
    """Terms from ``low`` to ``high``, both included, in text (not numeric) order."""
    within = F.col("term").between(low.lower(), high.lower())
    return _constant(_of_field(index, field).where(within))


def wildcard_search(index: FieldIndex, field: str, pattern: str) -> DataFrame:
    matches = F.col("term").rlike(wildcard_regex(pattern.lower()))
    fixed = pattern.lower()
    for special in "*?\\":
        fixed = fixed.split(special, 1)[0]
    if fixed:
        matches = F.col("term").startswith(fixed) & matches
    return _constant(_matching_terms(index, field, matches))


def regex_search(index: FieldIndex, field: str, pattern: str) -> DataFrame:
    """Terms that match a whole regular expression, in Java syntax; literals in lower case."""
    matches = F.col("term").rlike(rf"\A(?:{lowered_pattern(pattern)})\z")
    return _constant(_matching_terms(index, field, matches))


def similar_terms(
    vocabulary: DataFrame, term: str, max_edits: int = 2, max_expansions: int | None = None
) -> DataFrame:
    """``(term, df, edits, similarity)``: the vocabulary terms within ``max_edits``.

    Similarity is 1 - edits / length of the shorter word and must be positive. With
    ``max_expansions`` only so many of the closest are kept, ties in term order.
    """
    target = term.lower()
    survivors = vocabulary.where(could_be_within(F.col("term"), target, max_edits))
    measured = survivors.withColumn("edits", edit_distance(F.col("term"), F.lit(target)))
    shorter = F.least(F.length("term"), F.lit(len(target)))
    close = measured.withColumn("similarity", 1 - F.col("edits") / shorter).where(
        (F.col("edits") <= max_edits) & (F.col("similarity") > 0)
    )
    if max_expansions is None:
        return close
    return close.orderBy(F.desc("similarity"), "term").limit(max_expansions)


def fuzzy_search(
    index: FieldIndex,
    field: str,
    term: str,
    max_edits: int = 2,
    max_expansions: int | None = None,
) -> DataFrame:
    """Documents with a term at most ``max_edits`` edits away, swaps included.

    Each expanded term adds BM25 times its similarity. All expansions share the highest
    document frequency among them, so that a rare misspelling does not outrank the word.
    Few expansions are listed in the postings filter, which then skips row groups; more are
    joined. Both ways give the same rows.
    """
    vocabulary = index.vocabulary.where(F.col("field") == field).select("term", "df")
    # Found once, however many there are.
    similar = similar_terms(vocabulary, term, max_edits, max_expansions)
    if index.saved:
        similar = saved_table(similar, "similar-terms")
    few = similar.limit(MAX_LISTED_TERMS + 1).collect()
    postings = _of_field(index, field)
    if not few:
        return match_all(index).where(F.lit(False))
    if len(few) <= MAX_LISTED_TERMS:
        pairs = [F.lit(x) for row in few for x in (row["term"], row["similarity"])]
        found = postings.where(F.col("term").isin([row["term"] for row in few])).withColumn(
            "similarity", F.element_at(F.create_map(*pairs), F.col("term"))
        )
        shared_df = F.lit(max(row["df"] for row in few))
    else:
        wanted = similar.select("term", "similarity")
        found = join_on_small(postings, wanted, ["term"], salt_by=["doc_id"])
        shared_df = similar.agg(F.max("df")).scalar()
    stats = index.stats(field)
    weight = F.col("similarity") * bm25(
        F.col("tf"), F.col("length"), shared_df, stats["n_docs"], stats["avg_length"]
    )
    return _hits(found.groupBy(*DOCUMENT).agg(F.sum(weight).alias("score")))


# --- combinations ----------------------------------------------------------------------
def boolean_search(
    index: FieldIndex,
    field: str,
    must: Sequence[str] | str = (),
    should: Sequence[str] | str = (),
    must_not: Sequence[str] | str = (),
    analyzer: Callable[[Column], Column] = words_standard,
) -> DataFrame:
    """All ``must`` words, no ``must_not`` word, at least one of ``should`` if no ``must``.

    The score adds BM25 of every positive word found. One aggregate per document
    decides and scores; no set operation and no self-join.
    """
    required, optional, excluded = (
        [term for _, term in _analyze(index, words, analyzer)]
        for words in (must, should, must_not)
    )
    weights = Counter(required) + Counter(optional)
    if not weights:
        return match_all(index).where(F.lit(False))
    scored = _term_scores(index, field, sorted(set(weights) | set(excluded)))
    term = F.col("term")
    weight = F.lit(0)
    for count in sorted(set(weights.values())):
        same = [t for t, c in weights.items() if c == count]
        weight = F.when(term.isin(same), count).otherwise(weight)
    per_doc = scored.groupBy(*DOCUMENT).agg(
        F.count_if(term.isin(sorted(set(required)))).alias("n_required"),
        F.count_if(term.isin(sorted(set(excluded)))).alias("n_excluded"),
        F.count_if(term.isin(sorted(weights))).alias("n_positive"),
        F.sum(weight * F.col("score")).alias("score"),
    )
    keep = (
        (F.col("n_required") == len(set(required)))
        & (F.col("n_excluded") == 0)
        & (F.col("n_positive") > 0)
    )
    return _hits(per_doc.where(keep))


def any_words(
    index: FieldIndex,
    field: str,
    words: Sequence[str] | str,
    analyzer: Callable[[Column], Column] = words_standard,
) -> DataFrame:
    """Documents with at least one of the words."""
    return boolean_search(index, field, should=words, analyzer=analyzer)


def _moved_back(positions: Column, offset: int) -> Column:
    return F.transform(positions, lambda p: p - offset)


def _phrase_scores(
    index: FieldIndex, field: str, phrases: list[list[tuple[int, str]]]
) -> DataFrame:
    """``(doc_id, score_0, score_1, ...)`` for documents that hold every phrase.

    A document contributes at most one row per distinct word, with its positions as an
    array. One shuffle on the id brings them together; a phrase starts where the
    position lists, each moved back by its word's offset, intersect.
    """
    terms = sorted({term for phrase in phrases for _, term in phrase})
    slot = {term: f"at_{i}" for i, term in enumerate(terms)}
    together = (
        _of_field(index, field)
        .where(F.col("term").isin(terms))
        .groupBy(*DOCUMENT, "length")
        .agg(*[F.max(F.when(F.col("term") == t, F.col("positions"))).alias(slot[t]) for t in terms])
    )
    together = together.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in slot.values()]))
    df = _document_frequencies(index, field, terms)
    stats = index.stats(field)
    scores, frequencies = [], []
    for i, phrase in enumerate(phrases):
        starts = [_moved_back(F.col(slot[term]), offset) for offset, term in phrase]
        frequencies.append(F.size(reduce(F.array_intersect, starts)).alias(f"freq_{i}"))
        idf = sum(bm25_idf(F.try_element_at(df, F.lit(term)), stats["n_docs"]) for _, term in phrase)
        scores.append(
            (idf * bm25_tf(F.col(f"freq_{i}"), F.col("length"), stats["avg_length"])).alias(f"score_{i}")
        )
    counted = together.select("doc_id", "length", *frequencies)
    complete = reduce(lambda a, b: a & b, [F.col(f"freq_{i}") > 0 for i in range(len(phrases))])
    return counted.where(complete).select("doc_id", *scores)


def phrase_search(
    index: FieldIndex,
    field: str,
    phrase: str,
    analyzer: Callable[[Column], Column] = words_standard,
) -> DataFrame:
    """Documents with the words next to each other in this order.

    Stop words are not matched but keep their place, in the query as in the documents.
    """
    terms = _analyze(index, phrase, analyzer)
    if not terms:
        return match_all(index).where(F.lit(False))
    scored = _phrase_scores(index, field, [terms])
    return _hits(scored.select("doc_id", F.col("score_0").alias("score")))


def multi_phrase_search(
    index: FieldIndex,
    field: str,
    phrases: Sequence[str],
    mode: str = "any",
    analyzer: Callable[[Column], Column] = words_standard,
) -> DataFrame:
    """``mode='any'``: any word of any phrase. ``mode='all_phrases'``: every phrase."""
    if mode == "any":
        return any_words(index, field, list(phrases), analyzer)
    if mode != "all_phrases":
        raise ValueError(f"unknown mode {mode!r}")
    analyzed = [terms for p in phrases if (terms := _analyze(index, p, analyzer))]
    if not analyzed:
        return match_all(index).where(F.lit(False))
    scored = _phrase_scores(index, field, analyzed)
    total = sum(F.col(f"score_{i}") for i in range(len(analyzed)))
    return _hits(scored.select("doc_id", total.alias("score")))


def disjunction_search(
    index: FieldIndex,
    fields: Sequence[str],
    words: Sequence[str] | str,
    multiplier: float = 0.0,
    analyzer: Callable[[Column], Column] = words_standard,
) -> DataFrame:
    """Best field score plus ``multiplier`` times the others.

    Each field is an any-word query with its own statistics. One aggregate per document
    sums every field in its own column.
    """
    terms = Counter(term for _, term in _analyze(index, words, analyzer))
    if not terms:
        return match_all(index).where(F.lit(False))
    fields = list(dict.fromkeys(fields))
    score = F.lit(None).cast("double")
    for field in fields:
        stats = index.stats(field)
        df = _document_frequencies(index, field, terms)
        in_field = bm25(
            F.col("tf"), F.col("length"), F.try_element_at(df, F.col("term")),
            stats["n_docs"], stats["avg_length"],
        )
        score = F.when(F.col("field") == field, in_field).otherwise(score)
    for term, count in terms.items():
        if count > 1:
            score = F.when(F.col("term") == term, score * count).otherwise(score)
    found = index.postings.where(
        F.col("field").isin(fields) & F.col("term").isin(list(terms))
    ).select(*DOCUMENT, "field", score.alias("score"))
    per_doc = found.groupBy(*DOCUMENT).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("field") == f, F.col("score"))), F.lit(0.0)).alias(f"s{i}")
            for i, f in enumerate(fields)
        ]
    )
    parts = [F.col(f"s{i}") for i in range(len(fields))]
    best = F.greatest(*parts) if len(parts) > 1 else parts[0]
    rest = reduce(lambda a, b: a + b, parts) - best
    return _hits(per_doc.select("doc_id", (best + F.lit(float(multiplier)) * rest).alias("score")))


# --- fixed values: query types by name ---------------------------------------------------
SEARCHES: dict[str, Callable[..., DataFrame]] = {
    "term": term_search,
    "wildcard": wildcard_search,
    "prefix": prefix_search,
    "fuzzy": fuzzy_search,
    "regex": regex_search,
    "matchall": match_all,
    "phrase": phrase_search,
    "multiphrase": multi_phrase_search,
    "boolean": boolean_search,
    "termrange": range_search,
    "disjunction": disjunction_search,
}
# --- batches, totals -----------------------------------------------------------------------


def search(index: FieldIndex, query_type: str, *args, **options) -> DataFrame:
    """Run a search by its type name; an unknown type raises ``ValueError``."""
    kind = query_type.lower()
    if kind not in SEARCHES:
        raise ValueError(f"unknown query type {query_type!r}")
    return SEARCHES[kind](index, *args, **options)


def total_hits(hits: DataFrame) -> DataFrame:
    """Number of matching documents, before any top-k cut."""
    return hits.agg(F.count("*").alias("n_hits"))


def any_words_batch(
    index: FieldIndex,
    field: str,
    queries: DataFrame,
    analyzer: Callable[[Column], Column] = words_standard,
) -> DataFrame:
    """``(query_id, doc_id, score)`` for many any-word queries ``(query_id, text)``.

    Query words, with their document frequency, meet the postings in one equi-join on
    the term. The document frequencies tell how many rows that makes; if they are many, postings of a stored index are dealt by
    document into as many tasks as keep them bounded, and a document's scores are added up in the task that has it.
    """
    words = queries.select("query_id", F.explode_outer(drop_stop_words(analyzer(F.col("text")))).alias("term"))
    wanted = (
        words.where(F.col("term").isNotNull())
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("weight"))
    )
    # One row per distinct query word, no larger than the measured queries.
    small = fits_broadcast(wanted)
    hint = F.broadcast if small else (lambda df: df)
    frequencies = (
        index.vocabulary.where(F.col("field") == field)
        .select("term", "df")
        .join(hint(wanted.select("term").distinct()), "term", "left_semi")
    )
    weighted = wanted.join(hint(frequencies), "term")
    postings = _of_field(index, field)
    if small and not index.saved:
        # Moves below the grouping of tokens, so that only query words are shuffled.
        postings = postings.join(hint(wanted.select("term").distinct()), "term", "left_semi")
    tasks = _batch_tasks(weighted) if index.saved and not index.clustered else 1
    if tasks > 1 and small:
        asked = postings.join(hint(frequencies.select("term")), "term", "left_semi")
        postings = asked.select(*DOCUMENT, "term", "tf", "length").repartition(tasks, *DOCUMENT)
    found = join_on_small(postings, weighted, ["term"], salt_by=["doc_id"], small_fits=small)
    if tasks > 1 and not small:
        found = found.repartition(tasks, "query_id", *DOCUMENT)
    stats = index.stats(field)
    score = F.col("weight") * bm25(
        F.col("tf"), F.col("length"), F.col("df"), stats["n_docs"], stats["avg_length"]
    )
    summed = found.groupBy("query_id", *DOCUMENT).agg(F.sum(score).alias("score"))
    return summed.select("query_id", "doc_id", "score")


def _batch_tasks(weighted: DataFrame) -> int:
    """Tasks for the rows of ``(query_id, term, weight, df)`` with the postings of their terms."""
    rows = weighted.agg(F.sum("df")).first()[0] or 0
    return 1 if rows <= BATCH_ROWS else max(weighted.sparkSession.sparkContext.defaultParallelism, -(-rows // BATCH_ROWS))


def total_hits_batch(hits: DataFrame, query: str = "query_id") -> DataFrame:
    return hits.groupBy(query).agg(F.count("*").alias("n_hits"))
