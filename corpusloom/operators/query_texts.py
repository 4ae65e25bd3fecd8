"""Tables of query texts, answered in one plan.

Texts are read into clause trees (:mod:`corpusloom.functions.query_text`). The words, patterns, ranges and fuzzy words of all
queries meet the postings in one equi-join on the term; what a document has of a query is
gathered in one row, where phrases are lined up and the tree is decided and scored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.alignment import phrase_frequency
from ..functions.query_text import query_tree, read_line
from ..functions.scoring import bm25_idf, bm25_tf
from ..functions.text import STOP_WORDS, words_standard
from ..plans.joins import fits_broadcast, join_on_small
from ..plans.scratch import scratch_path
from .fields import DOCUMENT, FieldIndex
from .lookup import LISTED, Lookup, terms_of_patterns, terms_of_ranges, terms_within
from .search import search


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_queries(queries: DataFrame, field: str, analyzer: Callable[[Column], Column] = words_standard) -> DataFrame:
    """``(query_id, leaves, nodes, error)`` of ``(query_id, text)``; leaves have ``words`` with their offsets.

    Words and phrases go through the analyzer; stop words leave a gap. A leaf without a word
    counts as absent from its tree.
    """
    read = queries.select("query_id", query_tree(F.col("text")).alias("tree"))
    words = F.transform(
        "tree.leaves", lambda leaf: F.when(leaf["kind"].isin("word", "phrase"), analyzer(leaf["text"]))
    )
    read = read.select("query_id", "tree", words.alias("words"))

    def kept(found: Column) -> Column:
        placed = F.transform(found, lambda w, at: F.struct(at.alias("offset"), w.alias("term")))
        return F.filter(placed, lambda w: ~w["term"].isin(STOP_WORDS))

    leaves = F.transform(
        F.arrays_zip(F.col("tree.leaves").alias("leaf"), F.col("words").alias("words")),
        lambda both, number: F.struct(
            number.alias("leaf"),
            both["leaf"]["kind"].alias("kind"),
            F.coalesce(both["leaf"]["field"], F.lit(field)).alias("field"),
            both["leaf"]["text"].alias("text"),
            both["leaf"]["low"].alias("low"),
            both["leaf"]["high"].alias("high"),
            both["leaf"]["number"].alias("number"),
            kept(both["words"]).alias("words"),
        ),
    )
    return read.select("query_id", leaves.alias("leaves"), F.col("tree.nodes").alias("nodes"), F.col("tree.error").alias("error"))


def _wanted(index: FieldIndex, read: DataFrame, lookup: Lookup | None) -> DataFrame:
    """``(query_id, leaf, kind, slot, offset, field, term, idf)``: every index term that a leaf asks for.

    Terms of patterns and ranges have no ``idf``: they count 1. Terms of a fuzzy word share
    the highest document frequency among them, weighed by their similarity.
    """
    leaves = _saved(read.select("query_id", F.inline("leaves")), "query-leaves")
    words = leaves.where(F.col("kind").isin("word", "phrase")).select(
        "query_id", "leaf", "kind", "field", F.posexplode("words").alias("slot", "word")
    )
    words = words.select("query_id", "leaf", "kind", "slot", F.col("word.offset").alias("offset"), "field", F.col("word.term").alias("term"))
    stats = index.lengths.groupBy("field").agg(F.sum("n_docs").alias("n_docs"))
    terms = words.select("field", "term").distinct()
    counted = join_on_small(index.vocabulary, terms, ["field", "term"], salt_by=["term"]).join(F.broadcast(stats), "field")
    idf = counted.select("field", "term", bm25_idf(F.col("df"), F.col("n_docs")).alias("idf"))
    found = words.join(F.broadcast(idf) if fits_broadcast(idf) else idf, ["field", "term"])
    columns = ["query_id", "leaf", "kind", "slot", "offset", "field", "term", "idf"]
    found = found.select(*columns)
    kinds = {row["kind"] for row in leaves.select("kind").distinct().collect()}
    none = F.lit(None).cast("double")

    def named(expanded: DataFrame, kind: str, weight: Column) -> DataFrame:
        key = expanded.select("*", F.col("key.query_id").alias("query_id"), F.col("key.leaf").alias("leaf"))
        zero = F.lit(0)
        return key.select("query_id", "leaf", F.lit(kind).alias("kind"), zero.alias("slot"), zero.alias("offset"), "field", "term", weight.alias("idf"))

    key = F.struct("query_id", "leaf").alias("key")
    if "pattern" in kinds:
        patterns = leaves.where("kind = 'pattern'").select(key, "field", F.col("text").alias("pattern"))
        found = found.unionByName(named(terms_of_patterns(index, patterns, lookup), "constant", none))
    if "range" in kinds:
        ranges = leaves.where("kind = 'range'").select(key, "field", "low", "high")
        found = found.unionByName(named(terms_of_ranges(index, ranges), "constant", none))
    if "fuzzy" in kinds:
        fuzzy = leaves.where("kind = 'fuzzy'").select(
            key, "field", F.col("text").alias("word"), F.least(F.col("number"), F.lit(2.0)).cast("int").alias("max_edits")
        )
        near = _saved(terms_within(index, fuzzy, lookup), "fuzzy-terms")
        shared = near.groupBy("key").agg(F.max("df").alias("shared"))
        near = near.join(F.broadcast(shared) if fits_broadcast(shared) else shared, "key").join(F.broadcast(stats), "field")
        found = found.unionByName(named(near, "fuzzy", F.col("similarity") * bm25_idf(F.col("shared"), F.col("n_docs"))))
    return _saved(found, "query-terms")


def _decided(nodes: Column, leaves: Column) -> Column:
    """``struct<hit, score>`` of the root, from nodes with the children first and the results of leaves."""

    def step(done: Column, node: Column) -> Column:
        def of(name: str) -> Column:
            return F.filter(F.transform(node[name], lambda n: F.get(done, n)), lambda r: r["live"])

        must, should, must_not = of("must"), of("should"), of("must_not")
        positive = F.filter(F.concat(must, should), lambda r: r["hit"])
        group = F.struct(
            ((F.size(must) > 0) | (F.size(should) > 0) | (F.size(must_not) > 0)).alias("live"),
            (
                (F.size(positive) > 0)
                & F.forall(must, lambda r: r["hit"])
                & ~F.exists(must_not, lambda r: r["hit"])
            ).alias("hit"),
            F.aggregate(positive, F.lit(0.0), lambda total, r: total + r["score"]).alias("score"),
        )
        result = F.when(node["leaf"].isNotNull(), F.get(leaves, node["leaf"])).otherwise(group)
        boosted = F.struct(result["live"].alias("live"), result["hit"].alias("hit"), (result["score"] * node["boost"]).alias("score"))
        return F.concat(done, F.array(boosted))

    empty = F.array().cast("array<struct<live:boolean,hit:boolean,score:double>>")
    return F.element_at(F.aggregate(nodes, empty, step), -1)


def query_hits(
    index: FieldIndex,
    field: str,
    queries: DataFrame,
    analyzer: Callable[[Column], Column] = words_standard,
    lookup: Lookup | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score)`` of query texts ``(query_id, text)``; ``field`` is that of clauses that name none.

    A group holds in a document if all its ``+`` clauses do, no ``-`` clause does and at least one that isn't ``-``; so
    one of ``-`` clauses only holds nowhere. Its score is the sum over its other clauses: BM25 for words and
    phrases, 1 for patterns and ranges. Clauses without a word (stop words) are as if absent. A text that cannot be read
    has no hits, see :func:`unreadable`; null texts and repeated ids are such texts and queries of their own kind:
    ids are expected to be unique. With a ``lookup`` patterns and fuzzy words are found without a scan of the vocabulary.
    """
    read = _saved(read_queries(queries, field, analyzer), "query-trees")
    wanted = _wanted(index, read, lookup)
    stats = index.lengths.groupBy("field").agg(F.try_divide(F.sum("total"), F.sum("n_docs")).alias("avg_length"))
    terms = wanted.select("term").distinct().limit(LISTED + 1).collect()
    postings = index.postings
    if len(terms) <= LISTED:  # row groups without them are skipped
        postings = postings.where(F.col("term").isin([row["term"] for row in terms]))
    found = join_on_small(postings, wanted, ["field", "term"], salt_by=["doc_id"]).join(F.broadcast(stats), "field")
    tf = bm25_tf(F.col("tf"), F.col("length"), F.col("avg_length"))
    phrase = F.col("kind") == "phrase"
    gathered = found.groupBy("query_id", *DOCUMENT).agg(
        F.collect_list(
            F.when(~phrase, F.struct("leaf", F.coalesce(F.col("idf") * tf, F.lit(1.0)).alias("score"), F.col("idf").isNull().alias("constant")))
        ).alias("words"),
        F.collect_list(
            F.when(phrase, F.struct("leaf", "slot", "offset", "positions", "idf", "length", "avg_length"))
        ).alias("phrases"),
    )
    trees = read.where(F.size("nodes") > 0).select("query_id", "leaves", "nodes")
    joined = gathered.join(F.broadcast(trees) if fits_broadcast(trees) else trees, "query_id")
    # A tree holds only where one of its leaves does, and a phrase only where all its words are: most documents have a part of
    # one, and are left out before positions are lined up.
    joined = joined.where(
        (F.size("words") > 0)
        | F.exists(
            "leaves",
            lambda leaf: (leaf["kind"] == "phrase")
            & (F.size(leaf["words"]) > 0)
            & (F.size(F.filter("phrases", lambda w: w["leaf"] == leaf["leaf"])) == F.size(leaf["words"])),
        )
    )

    def result(leaf: Column) -> Column:
        mine = F.filter("words", lambda w: w["leaf"] == leaf["leaf"])
        total = F.aggregate(mine, F.lit(0.0), lambda t, w: t + w["score"])
        placed = F.array_sort(
            F.transform(
                F.filter("phrases", lambda w: w["leaf"] == leaf["leaf"]),
                lambda w: F.struct(*[w[c].alias(c) for c in ("slot", "offset", "positions", "idf", "length", "avg_length")]),
            )
        )
        is_phrase = leaf["kind"] == "phrase"

        def lined_up(placed: Column) -> Column:
            whole = (F.size(leaf["words"]) > 0) & (F.size(placed) == F.size(leaf["words"]))
            frequency = F.when(whole, phrase_frequency(placed, leaf["number"].cast("int"))).otherwise(0.0)
            idf = F.aggregate(placed, F.lit(0.0), lambda t, w: t + w["idf"])
            first = F.get(placed, F.lit(0))
            return F.struct(frequency.alias("frequency"), idf.alias("idf"), first["length"].alias("length"), first["avg_length"].alias("avg_length"))

        def judged(phrase: Column) -> Column:
            score = phrase["idf"] * bm25_tf(phrase["frequency"], phrase["length"], phrase["avg_length"])
            return F.struct(
                (leaf["words"].isNull() | (F.size(leaf["words"]) > 0)).alias("live"),
                F.when(is_phrase, phrase["frequency"] > 0).otherwise(F.size(mine) > 0).alias("hit"),
                F.when(is_phrase, F.coalesce(score, F.lit(0.0)))
                .when(F.exists(mine, lambda w: w["constant"]), 1.0)
                .otherwise(total)
                .alias("score"),
            )

        # Arrays of one, so that each is worked out once.
        return F.get(F.transform(F.transform(F.array(placed), lined_up), judged), F.lit(0))

    # Exploded, as a filter on what they come to would have both worked out again.
    results = joined.select("query_id", "doc_id", "nodes", F.explode_outer(F.array(F.transform("leaves", result))).alias("results"))
    decided = results.select(
        "query_id", "doc_id", F.explode_outer(F.array(_decided(F.col("nodes"), F.col("results")))).alias("root")
    )
    return decided.where("root.hit").select("query_id", "doc_id", F.col("root.score").alias("score"))


def unreadable(queries: DataFrame) -> DataFrame:
    """``(query_id, error)`` of the query texts that are not well formed."""
    read = queries.select("query_id", query_tree(F.col("text"))["error"].alias("error"))
    return read.where(F.col("error").isNotNull())


def query_search(
    index: FieldIndex, field: str, text: str, analyzer: Callable[[Column], Column] = words_standard, lookup: Lookup | None = None
) -> DataFrame:
    """``(doc_id, score)`` of one query text; one that cannot be read raises ``ValueError``."""
    spark = index.postings.sparkSession
    one = spark.range(1).select(F.lit(0).alias("query_id"), F.lit(text).alias("text"))
    error = unreadable(one).first()
    if error:
        raise ValueError(error["error"])
    return query_hits(index, field, one, analyzer, lookup).select("doc_id", "score")


#: Types whose text is a query text, whatever the name.
QUERY_TYPES = ("phrase", "multiphrase", "boolean")


def search_line(index: FieldIndex, line: str, lookup: Lookup | None = None) -> DataFrame:
    """Hits of a line ``type field text``: see :func:`~corpusloom.functions.query_text.read_line`.

    The text of ``phrase``, ``multiphrase`` and ``boolean`` is a query text: quoted words are a phrase, words in
    brackets are not.
    """
    kind, arguments = read_line(line)
    if kind in QUERY_TYPES:
        return query_search(index, *arguments, lookup=lookup)
    return search(index, kind, *arguments)


def phrase_batch(
    index: FieldIndex, field: str, queries: DataFrame, analyzer: Callable[[Column], Column] = words_standard
) -> DataFrame:
    """``(query_id, doc_id, score)`` of phrases ``(query_id, text, slop)``.

    Matches are those of :func:`~corpusloom.functions.alignment.phrase_frequency`; slop 0 gives what
    ``phrase_search`` gives. Words next to each other in another order are two moves apart.
    """
    quoted = F.concat(F.lit('"'), F.regexp_replace("text", r'(["\\])', r"\\$1"), F.lit('"~'), F.col("slop").cast("string"))
    return query_hits(index, field, queries.select("query_id", quoted.alias("text")), analyzer)
