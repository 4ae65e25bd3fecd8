"""Every operator as a query over the shared test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions.bib import author_list, entry_key, plain_text
from .functions.stemming import stem_vocabulary, stem_words
from .functions.text import words_alpha, words_clean, words_standard
from .operators import fields as fielded
from .operators import best, clustered, frequency, lookup, postings, proximity, query_texts, search
from .operators.tables import write_frequency_tables
from .plans.parallelism import spread_small_scan
from .plans.ranking import display_scores, place_of, top_k, top_k_per_query
from .plans.scratch import opened_for_writing, saved_table, scratch_path
from .session import ship_package
from .sources import bibliography
from .sources.corpus import file_names, from_table, numbered_files, read_corpus, read_corpus_lines
from .streaming.incremental import corpus_stream, state_on_disk
from .streaming.running import open_counts, running_counts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    @wraps(run)
    def with_package(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    _QUERIES[run.__name__] = with_package
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_table(_table(spark, sf_dir, "documents"))


def _clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.positioned_tokens(_docs(spark, sf_dir), stemmed=False)


_STORED: dict[tuple, str] = {}


def _written(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple:
    """Names, sizes and times of the files of some tables: another listing means other tables."""
    found = []
    for name in tables:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files = system.listStatus(folder)
        found += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(found))


def _stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Path of what ``write`` has stored, once for each application and state of the tables."""
    key = (spark.sparkContext.applicationId, name, _written(spark, sf_dir, ("documents", "part")))
    if key not in _STORED:
        path = scratch_path(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def _text_index(spark: SparkSession, sf_dir: str) -> fielded.FieldIndex:
    """The stored index of the documents, written by the first query that asks for it."""
    fields = fielded.fields_of_columns(_docs(spark, sf_dir), "doc_id", text="text")
    path = _stored(spark, sf_dir, "text-index", lambda path: fielded.write_index(fields, path))
    return fielded.open_index(spark, path)


def _text_lookup(spark: SparkSession, sf_dir: str) -> lookup.Lookup:
    """The stored pattern and edit lookup of the documents' vocabulary."""
    index = _text_index(spark, sf_dir)
    return lookup.open_lookup(spark, _stored(spark, sf_dir, "text-lookup", lambda path: lookup.write_lookup(index, path)))


def _part_index(spark: SparkSession, sf_dir: str) -> fielded.FieldIndex:
    part = spread_small_scan(_table(spark, sf_dir, "part"))
    fields = fielded.fields_of_columns(part, "p_partkey", name="p_name", type="p_type")
    path = _stored(spark, sf_dir, "part-index", lambda path: fielded.write_index(fields, path))
    return fielded.open_index(spark, path)


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


def _joined(column: str) -> Column:
    return F.array_join(F.transform(column, lambda p: p.cast("string")), ",").alias(column)


# --- frequency tables -------------------------------------------------------------------
@_query
def letter_counts(spark, sf_dir):
    return frequency.letter_counts(_docs(spark, sf_dir))


@_query
def unigram_counts(spark, sf_dir):
    return frequency.ngram_counts(_docs(spark, sf_dir), 1)


@_query
def bigram_counts(spark, sf_dir):
    return frequency.ngram_counts(_docs(spark, sf_dir), 2)


@_query
def trigram_counts(spark, sf_dir):
    return frequency.ngram_counts(_docs(spark, sf_dir), 3)


@_query
def bigram_by_lang(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return frequency.ngram_counts(spread_small_scan(documents), 2, by=("lang",))


@_query
def unigrams_alphabetical(spark, sf_dir):
    return frequency.rank_alphabetical(frequency.ngram_counts(_docs(spark, sf_dir), 1))


def _ranked(spark, sf_dir, n):
    return _first_places(frequency.ngrams(_docs(spark, sf_dir), n))


def _first_places(occurrences: DataFrame) -> DataFrame:
    return _ranked_places(frequency.counts_from_ngrams(occurrences))


def _ranked_places(counts: DataFrame) -> DataFrame:
    ranked = frequency.rank_by_count(counts)
    first_doc, first_pos = place_of(F.col("first"))
    return ranked.select("ngram", "n", first_doc.alias("first_doc"), first_pos.alias("first_pos"))


@_query
def unigrams_ranked(spark, sf_dir):
    return _ranked(spark, sf_dir, 1)


@_query
def bigrams_ranked(spark, sf_dir):
    return _ranked(spark, sf_dir, 2)


@_query
def trigrams_ranked(spark, sf_dir):
    return _ranked(spark, sf_dir, 3)


@_query
def tokens_strip_first(spark, sf_dir):
    return frequency.ngram_counts(
        _docs(spark, sf_dir), 1, lambda text: words_alpha(text, strip_first=True)
    )


@_query
def merged_counts(spark, sf_dir):
    """Counts of English and of all other documents, added up."""
    documents = spread_small_scan(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    return frequency.merge_counts(
        frequency.ngram_counts(documents.where(english), 1),
        frequency.ngram_counts(documents.where(~english), 1),
    )


@_query
def frequency_files(spark, sf_dir):
    """The CSV frequency tables, written and read back."""
    out = scratch_path(spark, "frequency")
    write_frequency_tables(_docs(spark, sf_dir), out, compression="gzip")
    names = ["uni", "uni_alpha", "bi_dat", "bii_alpha", "tri_dat", "tii_alpha", "letters"]
    parts = [
        spark.read.schema("ngram string, n bigint")
        .option("lineSep", "\n" if name == "letters" else "\r\n").csv(f"{out}/{name}")
        .select(F.lit(name).alias("name"), "ngram", "n")
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)


#: Documents to a file, so that files grow in number and not in size.
PER_FILE = 500


def _third(spark: SparkSession, folder: str) -> int:
    """A third of the files of a folder, for three micro-batches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
    return max(1, -(-len(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)) // 3))


def _corpus_folder(spark: SparkSession, sf_dir: str) -> str:
    """The documents as a folder of UTF-8 ``.txt`` files, several documents to a file.

    Words and letters are counted per word, so how documents fall into files is no matter.
    """
    folder = scratch_path(spark, "corpus")
    _docs(spark, sf_dir).select("text").write.option("maxRecordsPerFile", PER_FILE).text(folder)
    return folder


def _document_folder(spark: SparkSession, sf_dir: str) -> str:
    """A Latin-1 ``.txt`` file for each document, and a file of another kind."""
    folder = scratch_path(spark, "files")

    def write(frames):
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                with opened_for_writing(f"{folder}/d{doc_id:09d}.txt") as out:
                    out.write(text.encode("latin-1", "replace"))
            yield frame[["doc_id"]]

    _docs(spark, sf_dir).mapInPandas(write, "doc_id bigint").write.format("noop").mode("overwrite").save()
    with opened_for_writing(f"{folder}/notes.md") as out:
        out.write(b"not a part of the corpus")
    return folder


@_query
def corpus_scan_ranked(spark, sf_dir):
    """Bigrams of a folder of Latin-1 files by count, ties in the order of file names."""
    folder = _document_folder(spark, sf_dir)
    corpus = numbered_files(read_corpus(spark, folder, ".txt"), file_names(spark, folder, ".txt"))
    return _first_places(frequency.ngrams(corpus, 2))


@_query
def corpus_scan_letters(spark, sf_dir):
    corpus = read_corpus(spark, _corpus_folder(spark, sf_dir), encoding="UTF-8")
    return frequency.letter_counts(corpus)


@_query
def corpus_scan_unigrams(spark, sf_dir):
    corpus = read_corpus(spark, _corpus_folder(spark, sf_dir), ".txt", encoding="UTF-8")
    return frequency.ngram_counts(corpus, 1)


@_query
def corpus_lines_terms(spark, sf_dir):
    """Words of long files, numbered across lines and indexed by blocks of positions."""
    lines = read_corpus_lines(spark, _corpus_folder(spark, sf_dir))
    tokens = postings.position_lines(lines, words_clean)
    summary = postings.postings_summary(postings.build_postings(tokens, by_block=True))
    return summary.select("term", "total")


@_query
def streamed_bigrams_ranked(spark, sf_dir):
    """Word pairs by count, kept by a stream that reads the documents in several micro-batches."""
    folder, table = scratch_path(spark, "arriving"), scratch_path(spark, "counts")
    _docs(spark, sf_dir).write.option("maxRecordsPerFile", PER_FILE * 10).parquet(folder)
    stream = spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", _third(spark, folder)).parquet(folder)
    running_counts(stream, 2, table).option("checkpointLocation", scratch_path(spark, "stream")).trigger(
        availableNow=True
    ).start().awaitTermination()
    return _ranked_places(open_counts(spark, table))


@_query
def streamed_unigrams(spark, sf_dir):
    """Counts kept by a stream over the corpus folder, after the last of its micro-batches."""
    folder = _corpus_folder(spark, sf_dir)
    stream = corpus_stream(state_on_disk(spark), folder, ".txt", encoding="UTF-8", max_files=_third(spark, folder))
    table = scratch_path(spark, "running")
    frequency.ngram_counts(stream, 1).writeStream.outputMode("complete").option(
        "checkpointLocation", scratch_path(spark, "stream")
    ).foreachBatch(
        lambda counts, _: counts.write.mode("overwrite").parquet(table)
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(table)


# --- positional index ---------------------------------------------------------------------
@_query
def clean_token_counts(spark, sf_dir):
    return frequency.ngram_counts(_docs(spark, sf_dir), 1, words_clean)


@_query
def stemmed_vocabulary(spark, sf_dir):
    return stem_vocabulary(_clean_tokens(spark, sf_dir))


@_query
def stemmed_term_counts(spark, sf_dir):
    """Counted as they are written first, so that each distinct word is stemmed once."""
    counts = frequency.ngram_counts(_docs(spark, sf_dir), 1, words_clean)
    stem = F.get(stem_words(F.array("ngram")), F.lit(0))
    return counts.select(stem.alias("term"), "n").groupBy("term").agg(F.sum("n").alias("n"))


@_query
def postings_positions(spark, sf_dir):
    index = postings.build_postings(_clean_tokens(spark, sf_dir))
    return index.select("term", "doc_id", "tf", _joined("positions"))


@_query
def postings_dump(spark, sf_dir):
    """The readable copy of the postings, read back."""
    path = scratch_path(spark, "dump")
    tokens = postings.positioned_tokens(postings.by_document(_docs(spark, sf_dir)), stemmed=False)
    postings.dump_postings(postings.build_postings(tokens), path, compression="gzip")
    dumped = spark.read.schema("term string, doc_id bigint, positions array<int>, tf int").json(path)
    return dumped.select("term", "doc_id", "tf", _joined("positions"))


@_query
def postings_summary(spark, sf_dir):
    return postings.postings_summary(postings.build_postings(_clean_tokens(spark, sf_dir)))


@_query
def term_lookup(spark, sf_dir):
    index = postings.build_postings(_clean_tokens(spark, sf_dir))
    return postings.term_lookup(index, "from")


@_query
def saved_postings_lookup(spark, sf_dir):
    """Stemmed postings built and saved once, then opened and queried."""
    path = scratch_path(spark, "postings")
    for _ in range(2):
        index = postings.ensure_postings(
            spark,
            path,
            lambda: postings.positioned_tokens(_docs(spark, sf_dir)),
        )
    return postings.term_lookup(index, postings.query_terms(spark, "From")[0])


@_query
def phrase_pair(spark, sf_dir):
    return proximity.proximity(_clean_tokens(spark, sf_dir), "of", "the")


@_query
def phrase_pair_ordered(spark, sf_dir):
    return proximity.proximity(_clean_tokens(spark, sf_dir), "of", "the", ordered=True)


@_query
def proximity_3(spark, sf_dir):
    return proximity.proximity(_clean_tokens(spark, sf_dir), "from", "the", 3)


@_query
def proximity_self(spark, sf_dir):
    return proximity.proximity(_clean_tokens(spark, sf_dir), "la", "la", 5)


@_query
def proximity_documents(spark, sf_dir):
    found = proximity.proximity(_clean_tokens(spark, sf_dir), "die", "der", 4)
    return proximity.positions_per_document(found).select("doc_id", _joined("positions"))


def _item_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of a benchmark item with the next but one, at distances 0 to 5."""
    words = _table(spark, sf_dir, "benchmark").select("item_id", words_clean(F.col("text")).alias("w"))
    placed = words.select("item_id", "w", F.posexplode("w").alias("at", "w1"))
    return placed.where(F.col("at") + 2 < F.size("w")).select(
        F.concat_ws("-", "item_id", "at").alias("query_id"),
        "w1",
        F.pmod("item_id", F.lit(6)).cast("int").alias("max_dist"),
        F.get("w", F.col("at") + 2).alias("w2"),
    )


def _matches_per_query(found: DataFrame) -> DataFrame:
    return found.groupBy("query_id").agg(
        F.count("*").alias("n"),
        F.countDistinct("doc_id").alias("n_docs"),
        F.sum(F.col("doc_id") * 31 + F.col("pos")).cast("bigint").alias("places"),
    )


@_query
def proximity_batch(spark, sf_dir):
    """Every pair of words one apart in a benchmark item, with sums over the matches."""
    queries = _item_pairs(spark, sf_dir)
    return _matches_per_query(proximity.proximity_batch(_clean_tokens(spark, sf_dir), queries))


def _position_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    slash = F.concat(F.lit(" /"), F.col("max_dist").cast("string"), F.lit(" "))
    return _item_pairs(spark, sf_dir).select("query_id", F.concat("w1", slash, "w2").alias("text"))


@_query
def position_queries(spark, sf_dir):
    """Query texts ``word /n word`` made from every benchmark item, read into columns."""
    return proximity.position_queries(_position_texts(spark, sf_dir))


@_query
def position_queries_run(spark, sf_dir):
    """The same texts, stemmed, run over the positions of the saved, stemmed postings."""
    index = postings.ensure_postings(
        spark,
        _stored(spark, sf_dir, "stemmed-postings", lambda path: None),
        lambda: postings.positioned_tokens(_docs(spark, sf_dir)),
    )
    queries = proximity.position_queries(_position_texts(spark, sf_dir))
    return _matches_per_query(
        proximity.proximity_batch(postings.postings_positions(index), queries)
    )


# --- fielded search -----------------------------------------------------------------------
@_query
def field_stats(spark, sf_dir):
    stats = fielded.field_stats(_part_index(spark, sf_dir))
    return stats.withColumn("avg_len", F.round("avg_len", 6))


@_query
def vocabulary(spark, sf_dir):
    return _text_index(spark, sf_dir).vocabulary.select("term", "df")


@_query
def term_vectors(spark, sf_dir):
    vectors = fielded.term_vectors(_text_index(spark, sf_dir), "text")
    return vectors.select("doc_id", "term", "tf", _joined("positions"))


@_query
def term_search(spark, sf_dir):
    return _rounded(search.term_search(_text_index(spark, sf_dir), "text", "From"))


@_query
def term_bm25_top10(spark, sf_dir):
    hits = top_k(search.term_search(_text_index(spark, sf_dir), "text", "th"))
    return display_scores(_rounded(hits))


@_query
def boolean_search(spark, sf_dir):
    return _rounded(
        search.boolean_search(
            _text_index(spark, sf_dir), "text", must="from er", should="ha", must_not="ing"
        )
    )


@_query
def boolean_search_optional(spark, sf_dir):
    return _rounded(
        search.boolean_search(
            _text_index(spark, sf_dir), "text", should=["thor", "The", "que"], must_not="de"
        )
    )


@_query
def phrase_search(spark, sf_dir):
    return _rounded(search.phrase_search(_text_index(spark, sf_dir), "text", "de la"))


@_query
def phrase_search_gap(spark, sf_dir):
    """A stop word inside the phrase leaves a place any word may fill."""
    return _rounded(search.phrase_search(_text_index(spark, sf_dir), "text", "from the er"))


@_query
def multi_phrase_any(spark, sf_dir):
    return _rounded(
        search.multi_phrase_search(_text_index(spark, sf_dir), "text", ["de la", "und der"])
    )


@_query
def multi_phrase_all(spark, sf_dir):
    return _rounded(
        search.multi_phrase_search(
            _text_index(spark, sf_dir), "text", ["de la", "la de"], mode="all_phrases"
        )
    )


@_query
def prefix_search(spark, sf_dir):
    return search.prefix_search(_text_index(spark, sf_dir), "text", "Tho")


@_query
def wildcard_search(spark, sf_dir):
    return search.wildcard_search(_text_index(spark, sf_dir), "text", "t?e*ing")


@_query
def wildcard_search_parts(spark, sf_dir):
    return search.wildcard_search(_part_index(spark, sf_dir), "name", "*i?get")


@_query
def regex_search(spark, sf_dir):
    return search.regex_search(_text_index(spark, sf_dir), "text", "(th|er)+in(g|ed)?")


@_query
def termrange_search(spark, sf_dir):
    """Order years as text terms, 1996 to 1998."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("string").alias("year")
    )
    index = fielded.build_index(fielded.fields_of_columns(orders, "o_orderkey", year="year"))
    return search.range_search(index, "year", "1996", "1998")


@_query
def fuzzy_terms(spark, sf_dir):
    words = _text_index(spark, sf_dir).vocabulary.where(F.col("field") == "text")
    similar = search.similar_terms(words, "thiner")
    return similar.select("term", "df", "edits", F.round("similarity", 6).alias("similarity"))


@_query
def fuzzy_search(spark, sf_dir):
    return _rounded(search.fuzzy_search(_text_index(spark, sf_dir), "text", "thiner"))


@_query
def fuzzy_search_50(spark, sf_dir):
    """The same with the fifty closest terms only."""
    return _rounded(search.fuzzy_search(_text_index(spark, sf_dir), "text", "thiner", max_expansions=50))


@_query
def refused_calls(spark, sf_dir):
    """Calls on the documents that must be refused, and whether each was."""
    index, docs = _text_index(spark, sf_dir), _docs(spark, sf_dir)
    path = scratch_path(spark, "index")
    nothing = fielded.fields_of_columns(docs.where(F.col("text").isNull() & F.col("text").isNotNull()), "doc_id", text="text")
    calls = {
        "index of no documents": lambda: fielded.write_index(nothing, path),
        "append to no index": lambda: fielded.write_index(fielded.fields_of_columns(docs, "doc_id", text="text"), path, "append"),
        "no such folder": lambda: read_corpus(spark, scratch_path(spark, "nowhere")),
        "unknown query type": lambda: search.search(index, "nearest", "text", "from"),
        "unbalanced query text": lambda: query_texts.query_search(index, "text", "(from"),
        "multiplier that is no number": lambda: query_texts.search_line(index, "disjunction much; text; from"),
    }
    found = []
    for name, call in calls.items():
        try:
            call()
            found.append((name, False))
        except (ValueError, FileNotFoundError, AnalysisException):
            found.append((name, True))
    return spark.createDataFrame(found, "call string, refused boolean")


@_query
def dismax_search(spark, sf_dir):
    return _rounded(
        search.disjunction_search(
            _part_index(spark, sf_dir), ["name", "type"], "small widget", multiplier=5
        )
    )


@_query
def match_all(spark, sf_dir):
    return search.match_all(_part_index(spark, sf_dir))


@_query
def match_all_count(spark, sf_dir):
    return search.total_hits(search.search(_part_index(spark, sf_dir), "matchall"))


def _benchmark_hits(spark, sf_dir):
    queries = _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), "text"
    )
    return search.any_words_batch(_text_index(spark, sf_dir), "text", queries)


@_query
def hit_totals(spark, sf_dir):
    return search.total_hits_batch(_benchmark_hits(spark, sf_dir))


@_query
def batch_top10(spark, sf_dir):
    """Best ten documents for every benchmark item, as an any-word query."""
    best = top_k_per_query(_benchmark_hits(spark, sf_dir).withColumn("score", F.round("score", 6)))
    return best.select("query_id", "doc_id", "score", "rank")


@_query
def term_search_one_byte(spark, sf_dir):
    """A term scored with document lengths as one byte holds them."""
    fields = fielded.fields_of_columns(_docs(spark, sf_dir), "doc_id", text="text")
    path = _stored(spark, sf_dir, "one-byte-index", lambda path: fielded.write_index(fields, path, one_byte_lengths=True))
    return _rounded(search.term_search(fielded.open_index(spark, path), "text", "from"))


@_query
def segmented_words(spark, sf_dir):
    """Words of all documents and of the same with combining accents, ideographs, numbers and a very long word added."""
    docs = _docs(spark, sf_dir)
    strange = F.concat(
        F.replace("text", F.lit("é"), F.lit("e\u0301")), F.lit(" 日本語テストー ひら don't 3.14 1,000.5 a_b ก็ดี x.1 "), F.repeat(F.lit("y"), 300)
    )
    both = docs.select("text").unionByName(docs.select(strange.alias("text")))
    words = both.select(F.explode_outer(words_standard(F.col("text"), unicode_words=True)).alias("term"))
    return words.where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("n"))


@_query
def block_max_top10(spark, sf_dir):
    """Best ten documents for every benchmark item, from the blocks that can hold them."""
    queries = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = _rounded(best.best_hits_batch(_text_index(spark, sf_dir), "text", queries))
    return top_k_per_query(found).select("query_id", "doc_id", "score", "rank")


@_query
def clustered_top10(spark, sf_dir):
    """Best ten documents for every benchmark item, scored where the postings of a document lie."""
    index = clustered.cluster_postings(_text_index(spark, sf_dir), buckets=16)
    queries = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = _rounded(search.any_words_batch(index, "text", queries))
    return top_k_per_query(found).select("query_id", "doc_id", "score", "rank")


@_query
def top10_and_total(spark, sf_dir):
    """The best ten hits of a query and the number of all, from one pass."""
    hits = search.any_words(_text_index(spark, sf_dir), "text", "from er ha")
    shown, total = best.top_k_with_total(_rounded(hits))
    return shown.withColumn("n_hits", F.lit(total).cast("bigint"))


def _item_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, w)``: the letters-only words of every benchmark item."""
    items = _table(spark, sf_dir, "benchmark")
    return items.select(F.col("item_id").alias("query_id"), words_alpha(F.col("text")).alias("w"))


@_query
def query_text_hits(spark, sf_dir):
    """A query text for every benchmark item, in eight forms: groups, phrases, signs, patterns, ranges."""
    a, b, c, d, e, f = (F.get("w", F.lit(n)) for n in range(6))
    text = F.concat
    forms = [
        text(F.lit("("), a, F.lit(" "), b, F.lit(")")),
        text(F.lit('"'), a, F.lit(" "), b, F.lit(" "), c, F.lit('"')),
        text(F.lit("+"), a, F.lit(" +"), b, F.lit(" -"), c),
        text(F.lit("-"), a, F.lit(" -"), b),
        text(a, F.lit(" AND "), b),
        text(F.lit("+("), a, F.lit(' "'), b, F.lit(" "), c, F.lit('") -('), d, F.lit(" "), e, F.lit(") "), f),
        text(F.lit("+"), F.substring(f, 1, 4), F.lit("* "), b),
        text(F.lit("["), f, F.lit(" to "), f, F.lit("zz] "), c),
    ]
    form = F.lit(None).cast("string")
    for number, made in enumerate(forms):
        form = F.when(F.col("query_id") % len(forms) == number, made).otherwise(form)
    queries = _item_words(spark, sf_dir).select("query_id", form.alias("text"))
    return _rounded(
        query_texts.query_hits(_text_index(spark, sf_dir), "text", queries, lookup=_text_lookup(spark, sf_dir))
    )


@_query
def phrase_slop_batch(spark, sf_dir):
    """Three words of every benchmark item in changed order, as phrases with a slop of 0 to 5."""
    queries = _item_words(spark, sf_dir).select(
        "query_id",
        F.concat_ws(" ", F.get("w", F.lit(1)), F.get("w", F.lit(0)), F.get("w", F.lit(3))).alias("text"),
        (F.col("query_id") % 6).cast("int").alias("slop"),
    )
    return _rounded(query_texts.phrase_batch(_text_index(spark, sf_dir), "text", queries))


@_query
def search_lines(spark, sf_dir):
    """Query lines as a user types them, one of each type."""
    text, part = _text_index(spark, sf_dir), _part_index(spark, sf_dir)
    lines = [
        (text, "term text from"), (text, "boolean text +From +er ha"), (text, 'phrase text "de la"'),
        (text, "multiphrase text (de la) and (la der)"), (text, "prefix text thin"), (text, "termrange text tha,thd"),
        (text, "wildcard text t?e*ing"), (part, "disjunction 5; name type; small widget"), (part, "matchall"),
    ]
    found = [query_texts.search_line(index, line).select(F.lit(line).alias("line"), "doc_id", "score") for index, line in lines]
    return _rounded(reduce(DataFrame.unionByName, found))


def _batch_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _item_words(spark, sf_dir).select(F.explode_outer("w").alias("word")).where(F.col("word").isNotNull())
    return words.distinct().select(F.col("word").alias("key"), F.lit("text").alias("field"), "word")


@_query
def wildcard_batch(spark, sf_dir):
    """Terms for a pattern with a leading wildcard from every word of the benchmark."""
    patterns = _batch_words(spark, sf_dir).withColumn(
        "pattern", F.concat(F.lit("*"), F.substring("word", 2, 3), F.lit("*"), F.right("word", F.lit(1)))
    )
    found = lookup.terms_of_patterns(_text_index(spark, sf_dir), patterns, _text_lookup(spark, sf_dir))
    return found.select("key", "term", "df")


@_query
def regex_batch(spark, sf_dir):
    """Terms for a regular expression from every word of the benchmark."""
    patterns = _batch_words(spark, sf_dir).withColumn(
        "pattern", F.concat(F.lit("[a-z]?"), F.substring("word", 1, 3), F.lit("(e|i[a-z])?"), F.substring("word", 4, 2), F.lit("."))
    )
    found = lookup.terms_of_patterns(_text_index(spark, sf_dir), patterns, _text_lookup(spark, sf_dir), syntax="regex")
    return found.select("key", "term", "df")


@_query
def fuzzy_batch(spark, sf_dir):
    """Terms within two edits of every word of the benchmark."""
    words = _batch_words(spark, sf_dir).withColumn("max_edits", F.lit(2))
    found = lookup.terms_within(_text_index(spark, sf_dir), words, _text_lookup(spark, sf_dir))
    return found.select("key", "term", "df", "edits", F.round("similarity", 6).alias("similarity"))


@_query
def saved_index_search(spark, sf_dir):
    """Two batches written to a stored index, searched over the sum of both."""
    path = scratch_path(spark, "index")
    documents = spread_small_scan(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    columns = {"text": "text", "lang": "lang"}
    fielded.write_index(
        fielded.fields_of_columns(documents.where(english), "doc_id", **columns), path
    )
    index = fielded.write_index(
        fielded.fields_of_columns(documents.where(~english), "doc_id", **columns), path, "append"
    )
    return _rounded(search.boolean_search(index, "text", should="de from er"))


@_query
def merged_index_search(spark, sf_dir):
    """Six batches appended, every seventh document deleted before and after a merge, and a search of what is left."""
    path = scratch_path(spark, "index")
    documents = spread_small_scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    for part in range(6):
        some = documents.where(F.col("doc_id") % 6 == part).withColumn("doc_id", F.col("doc_id").cast("string"))
        fielded.write_index(fielded.fields_of_columns(some, "doc_id", text="text"), path, "create" if part == 0 else "append")
    gone = documents.where(F.col("doc_id") % 7 == 0).select(F.col("doc_id").cast("string").alias("doc_id"))
    fielded.delete_documents(spark, path, gone.where(F.col("doc_id").cast("bigint") % 2 == 0))
    fielded.merge_batches(spark, path)
    fielded.delete_documents(spark, path, gone)
    index = fielded.merge_batches(spark, path, everything=True)
    hits = search.boolean_search(index, "text", should="from er ha")
    return _rounded(hits).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@_query
def index_modes(spark, sf_dir):
    """An index of parts overwritten by one of their types, then opened by a call that writes nothing."""
    path = scratch_path(spark, "index")
    part = spread_small_scan(_table(spark, sf_dir, "part"))
    names = fielded.fields_of_columns(part, "p_partkey", name="p_name")
    fielded.write_index(names, path)
    fielded.write_index(names, path, "append")
    fielded.write_index(fielded.fields_of_columns(part, "p_partkey", type="p_type"), path, "overwrite")
    index = fielded.write_index(names, path, "read")
    return fielded.field_stats(index).select("field", "n_docs", F.round("avg_len", 6).alias("avg_len"))


# --- bibliography ---------------------------------------------------------------------------
def _part_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(p_partkey, entry)``: parts as bibliography entries."""
    rendered = F.concat(
        F.lit("@part{p"), F.col("p_partkey").cast("string"),
        F.lit(",\n  title = {"), F.col("p_name"),
        F.lit("},\n  publisher = \""), F.col("p_brand"),
        F.lit("\",\n  series = {{"), F.col("p_type"),
        F.lit("}},\n  number = "), F.col("p_size").cast("string"),
        F.lit("\n}"),
    )
    return _table(spark, sf_dir, "part").select("p_partkey", rendered.alias("entry"))


def _parts_of(entries: DataFrame) -> DataFrame:
    field = F.col("fields")
    return entries.select(
        F.substring("cite_key", 2, 20).cast("bigint").alias("p_partkey"),
        "type",
        field["title"].alias("p_name"),
        field["publisher"].alias("p_brand"),
        F.translate(field["series"], "{}", "").alias("p_type"),
        field["number"].cast("int").alias("p_size"),
    )


@_query
def bib_roundtrip(spark, sf_dir):
    """Parts written as bibliography entries, read back as entries."""
    path = scratch_path(spark, "bibliography")
    _part_entries(spark, sf_dir).select(F.concat("entry", F.lit("\n")).alias("value")).write.text(path)
    return _parts_of(bibliography.read_bibliography(spark, path))


@_query
def bib_loose_layout(spark, sf_dir):
    """Parts as indented entries, two to a line, with free text around them."""
    path = scratch_path(spark, "bibliography")
    pairs = _part_entries(spark, sf_dir).groupBy(F.floor(F.col("p_partkey") / 2)).agg(
        F.array_join(F.array_sort(F.collect_list("entry")), " and ").alias("both")
    )
    pairs.select(F.concat(F.lit("notes (2015)\n  "), "both", F.lit(" see below")).alias("value")).write.text(path)
    return _parts_of(bibliography.read_bibliography(spark, path))


@_query
def bib_index_search(spark, sf_dir):
    """Orders as a bibliography file, its fields indexed; words of titles in a range of years."""
    path = scratch_path(spark, "bibliography")
    orders = _table(spark, sf_dir, "orders")
    rendered = F.concat(
        F.lit("@order{o"), F.col("o_orderkey").cast("string"), F.lit(", title = {"),
        F.col("o_orderpriority"), F.lit(" order "), F.col("o_custkey").cast("string"),
        F.lit("},\n year = "), F.year("o_orderdate").cast("string"), F.lit("}\n"),
    )
    orders.select(rendered.alias("value")).write.text(path)
    entries = saved_table(bibliography.first_of_each_key(bibliography.read_bibliography(spark, path)), "entries")
    index = fielded.write_index(bibliography.fields_of_entries(entries), scratch_path(spark, "index"))
    urgent = search.boolean_search(index, "title", must="urgent", should="7 77 100")
    years = search.range_search(index, "year", "1996", "1997").select("doc_id")
    keyed = entries.select("doc_id", F.substring("cite_key", 2, 20).cast("bigint").alias("o_orderkey"))
    found = _rounded(urgent).join(years, "doc_id").join(keyed, "doc_id")
    best = found.select(F.col("o_orderkey").alias("doc_id"), "score")
    return top_k(best).withColumnRenamed("doc_id", "o_orderkey")


@_query
def bib_state(spark, sf_dir):
    """Orders in files of several splits, whose entries depend on what stands before or around them.

    Strings are defined anew along a file, notes hold lines that look like entries, every order refers to the
    first of its 32.
    """
    path = scratch_path(spark, "bibliography")
    key = F.col("o_orderkey")
    text = F.col("o_orderkey").cast("string")
    rendered = F.concat(
        F.when(key % 512 == 0, F.concat(F.lit("@string{house = {House "), F.floor(key / 512).cast("string"), F.lit("}}\n"))).otherwise(""),
        F.lit("@order{o"), text, F.lit(",\n author = {M{\\\"u}ller, "), F.col("o_orderstatus"),
        F.lit("},\n note = {mail us\n@home or {"), F.col("o_orderpriority"), F.lit("}\n@misc{x, title = {y}}\n},"),
        F.lit(" publisher = house # \" Inc\", crossref = {o"), (F.floor(key / 32) * 32).cast("string"), F.lit("}"),
        F.when(key % 32 == 0, F.concat(F.lit(", series = {Series "), F.col("o_custkey").cast("string"), F.lit("}"))).otherwise(""),
        F.lit("}"),
    )
    orders = _table(spark, sf_dir, "orders").select(F.floor(key / 8192).alias("file"), "o_orderkey", rendered.alias("value"))
    filed = orders.repartition("file").sortWithinPartitions("file", "o_orderkey")
    filed.select("file", "value").write.partitionBy("file").text(path)
    split = spark.newSession()
    split.conf.set("spark.sql.files.maxPartitionBytes", 1 << 18)
    entries = bibliography.inherit_fields(bibliography.read_bibliography(split, path))
    found = scratch_path(spark, "entries")
    entries.write.parquet(found)
    field = F.col("fields")
    return spark.read.parquet(found).select(
        F.substring("cite_key", 2, 20).cast("bigint").alias("o_orderkey"),
        plain_text(field["author"]).alias("author"),
        field["note"].alias("note"),
        field["publisher"].alias("publisher"),
        field["series"].alias("series"),
        "complete",
    )


@_query
def bib_fields(spark, sf_dir):
    """Orders as entry texts, parsed and projected to fields with their keys."""
    orders = spread_small_scan(_table(spark, sf_dir, "orders"))
    entry = F.concat(
        F.lit("@order{o"), F.col("o_orderkey").cast("string"),
        F.lit(",\n author = {Clerk "), F.col("o_custkey").cast("string"),
        F.lit(" and "), F.col("o_orderstatus"), F.lit(", Anderson},\n title = \"Order "),
        F.col("o_orderpriority"), F.lit(": x\",\n year = "),
        F.year("o_orderdate").cast("string"), F.lit("\n}"),
    )
    entries = bibliography.parse_entries(
        orders.select(F.col("o_orderkey").alias("doc_id"), entry.alias("entry"))
    )
    fields = bibliography.fields_of_entries(entries)
    return fields.select("doc_id", "field", F.array_join("values", "|").alias("values"))


@_query
def bib_bad_entries(spark, sf_dir):
    """Entries without a year for open orders: kept, without a key, and counted."""
    orders = spread_small_scan(_table(spark, sf_dir, "orders"))
    year = F.when(F.col("o_orderstatus") != "O", F.concat(F.lit(", year = "), F.year("o_orderdate").cast("string"))).otherwise("")
    entry = F.concat(F.lit("@order{k, editor = {E}, title = {T}"), year, F.lit("}"))
    entries = bibliography.parse_entries(
        orders.select(F.col("o_orderkey").alias("doc_id"), entry.alias("entry"))
    )
    return bibliography.bad_entries(entries)


@_query
def entry_keys(spark, sf_dir):
    """Keys of parts: customer of the same number as author, size as year, name as title."""
    part, customer = (_table(spark, sf_dir, name) for name in ("part", "customer"))
    authored = part.join(customer, part.p_partkey == customer.c_custkey, "left").select(
        "p_partkey",
        # Parts without a customer have an editor; every seventh brand has neither.
        F.coalesce(
            F.concat("c_mktsegment", F.lit(", "), "c_name"),
            F.when(~F.col("p_brand").endswith("7"), F.concat("p_brand", F.lit(" Editor"))),
        ).alias("author"),
        F.concat("p_name", F.lit(" "), "p_brand", F.lit(": "), "p_type").alias("title"),
        F.col("p_size").cast("string").alias("year"),
    )
    return authored.select(
        "p_partkey", entry_key(F.col("author"), F.col("title"), F.col("year")).alias("key")
    )


def _author_split(spark, sf_dir, mode):
    """Each supplier with the next one, and a name that holds the letters *and*."""
    supplier = _table(spark, sf_dir, "supplier")
    nation = _table(spark, sf_dir, "nation")
    named = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey",
        F.concat("s_name", F.lit(" and Alexander "), "n_name").alias("author"),
    )
    return named.select(
        "s_suppkey", F.posexplode(author_list(F.col("author"), mode)).alias("ord", "name")
    )


@_query
def author_split_clean(spark, sf_dir):
    return _author_split(spark, sf_dir, "clean")


@_query
def author_split_literal(spark, sf_dir):
    return _author_split(spark, sf_dir, "literal")
