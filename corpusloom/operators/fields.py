"""Fielded documents and their index.

Documents with named, possibly repeated text fields are rows
``(doc_id, field, values ARRAY<STRING>)``. The index is three plain tables:

``postings``    ``(batch, field, term, doc_id, length, tf, positions)``; ``length`` is the
                number of indexed words of that document's field, stored with the posting
                so that scoring needs no join
``vocabulary``  ``(field, term, df)``
``lengths``     ``(field, n_docs, total)`` over documents with at least one word

A fourth, ``docs``, holds ``(doc_id, field, length)``, a fifth, ``blocks``, what the postings of a frequent term in a
block of documents score at most. All are sums over documents, so a stored index is a set of batches, added up
when it is opened. A document is known by its batch and id: ids need only be unique within a batch.

What counts is told by a log of numbered commits, each written once under a number of its own: documents added, a batch that
replaces all others, batches merged into one, documents deleted. A deletion is a batch of negative counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.scoring import one_byte_length
from ..plans.grouping import grouped_by_sorting
from ..plans.joins import fits_broadcast
from ..functions.text import STOP_WORDS, drop_stop_words, words_standard


DOCUMENT = ["batch", "doc_id"]

#: Documents in a block (as a power of two), blocks of documents whose ids aren't whole numbers, and how many
#: documents of a batch a term must be in to have its blocks listed.
BLOCK_BITS = 6
HASHED_BLOCKS = 1 << 14
FREQUENT = 256


@dataclass(frozen=True)
class FieldIndex:
    """Frames of a fielded index; ``saved`` tells that they are stored tables, ``clustered`` that postings lie by document.

    ``blocks`` of a stored index: ``(batch, field, term, block, n, max_tf, min_length)``.
    """

    docs: DataFrame
    postings: DataFrame
    vocabulary: DataFrame
    lengths: DataFrame
    saved: bool = False
    blocks: DataFrame | None = None
    clustered: bool = False

    def stats(self, field: str) -> Column:
        """``n_docs`` and ``avg_length`` of a field, as one scalar subquery."""
        totals = self.lengths.where(F.col("field") == field).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("total").alias("total")
        )
        return totals.select(
            F.struct(
                F.col("n_docs").alias("n_docs"),
                F.try_divide("total", "n_docs").alias("avg_length"),
            )
        ).scalar()


def fields_of_columns(df: DataFrame, doc_id: str, **columns: str) -> DataFrame:
    """``(doc_id, field, values)`` from columns: ``fields_of_columns(df, 'id', title='t')``."""
    pairs = [
        F.struct(F.lit(name).alias("field"), F.array(F.col(column).cast("string")).alias("values"))
        for name, column in columns.items()
    ]
    return df.select(F.col(doc_id).alias("doc_id"), F.inline(F.array(*pairs)))


def _analyzed(fields: DataFrame, analyzer: Callable[[Column], Column]) -> DataFrame:
    """``(doc_id, field, words, length)``: the values of a field are read as one text."""
    words = analyzer(F.array_join("values", "\n"))
    return fields.select("doc_id", "field", words.alias("words")).withColumn(
        "length", F.size(drop_stop_words(F.col("words")))
    )


def field_tokens(
    fields: DataFrame, analyzer: Callable[[Column], Column] = words_standard
) -> DataFrame:
    """``(doc_id, field, length, pos, term)``.

    Positions are numbered through all values of a field before stop words are removed,
    so removed words leave gaps; ``length`` counts the words that stay.
    """
    exploded = _analyzed(fields, analyzer).select(
        "doc_id", "field", "length", F.posexplode_outer("words").alias("at", "term")
    )
    return exploded.where(F.col("term").isNotNull() & ~F.col("term").isin(STOP_WORDS)).select(
        "doc_id", "field", "length", (F.col("at") + 1).alias("pos"), "term"
    )


def document_lengths(
    fields: DataFrame, analyzer: Callable[[Column], Column] = words_standard
) -> DataFrame:
    """``(doc_id, field, length)``, one row per document and field, without a shuffle."""
    return _analyzed(fields, analyzer).select("doc_id", "field", "length")


def field_lengths(lengths: DataFrame) -> DataFrame:
    """``(field, n_docs, total)`` of document lengths; documents without a word don't count."""
    return lengths.groupBy("field").agg(
        F.count_if(F.col("length") > 0).alias("n_docs"), F.sum("length").alias("total")
    )


def field_stats(index: FieldIndex) -> DataFrame:
    """``(field, n_docs, avg_len)``."""
    totals = index.lengths.groupBy("field").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("total").alias("total")
    )
    return totals.select("field", "n_docs", F.try_divide("total", "n_docs").alias("avg_len"))


def postings_of_tokens(tokens: DataFrame) -> DataFrame:
    """``(field, term, doc_id, length, tf, positions)``, positions ascending; ``block`` too if tokens have it."""
    block = [c for c in ("block",) if c in tokens.columns]
    # By term first, as it is written: a sort by the field, which is the same in most rows, compares all of them as a whole.
    grouped = tokens.groupBy("term", "field", *block, "doc_id", "length").agg(
        F.count("*").alias("tf"), F.sort_array(F.collect_list("pos")).alias("positions")
    )
    return grouped.select("field", "term", *block, "doc_id", "length", "tf", "positions")


def field_vocabulary(
    fields: DataFrame, analyzer: Callable[[Column], Column] = words_standard
) -> DataFrame:
    """``(field, term, df)`` from each document's distinct words.

    Counts combine on the map side, so a task sends one row per word it has seen, not one
    per document and word as counting postings would.
    """
    words = _analyzed(fields, analyzer).select(
        "field", F.explode_outer(F.array_distinct("words")).alias("term")
    )
    return (
        words.where(F.col("term").isNotNull() & ~F.col("term").isin(STOP_WORDS))
        .groupBy("field", "term")
        .agg(F.count("*").alias("df"))
    )


def build_index(
    fields: DataFrame, analyzer: Callable[[Column], Column] = words_standard
) -> FieldIndex:
    """Index as lazy frames over ``fields``; see :func:`write_index` to store it."""
    only = F.lit(0).alias("batch")
    return FieldIndex(
        docs=fields.select(only, "doc_id").distinct(),
        postings=postings_of_tokens(field_tokens(fields, analyzer)).select(only, "*"),
        vocabulary=field_vocabulary(fields, analyzer),
        lengths=field_lengths(document_lengths(fields, analyzer)),
    )


def term_vectors(index: FieldIndex, field: str) -> DataFrame:
    """``(doc_id, term, tf, positions)`` of one field."""
    return index.postings.where(F.col("field") == field).select(
        "doc_id", "term", "tf", "positions"
    )


def _table(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def block_of(doc_id: Column, kind: T.DataType) -> Column:
    """Block of a document: neighbours by number, or by a hash where ids aren't whole numbers."""
    if isinstance(kind, T.IntegralType):
        return F.shiftright(doc_id.cast("bigint"), BLOCK_BITS)
    return F.pmod(F.xxhash64(doc_id), F.lit(HASHED_BLOCKS)).cast("bigint")


@dataclass(frozen=True)
class _State:
    """Commits that count: batches of documents, batches of deletions, and the last commit that wasn't an addition."""

    batches: tuple[int, ...]
    deletions: tuple[int, ...]
    last: int


class _Log:
    """The numbered commits of a stored index.

    A number is claimed by creating a file that must not exist, so that two writers never have the same; a commit is a small
    table that appears as a whole. Additions always count. A merge or a deletion counts only if
    no other has come since it looked, which every reader decides alike from the log.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._root = self._hadoop(_table(path, "lengths"))
        self._system = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self._system.exists(self._root):
            return []
        names = [f.getPath().getName() for f in self._system.listStatus(self._root)]
        return sorted(
            int(n.removeprefix("commit="))
            for n in names
            if n.startswith("commit=") and self._system.exists(self._hadoop(self._root, f"{n}/_SUCCESS"))
        )

    def rows(self, numbers: list[int]) -> DataFrame:
        """``(commit, kind, base, removes, stream, delivery, batch, field, n_docs, total)``."""
        return self.spark.read.parquet(*[_table(self.path, f"lengths/commit={n}") for n in numbers])

    def state(self) -> _State | None:
        numbers = self.numbers()
        if not numbers:
            return None
        listed = self.rows(numbers).select("commit", "kind", "base", "removes").distinct().collect()
        live, last = {}, -1
        for row in sorted(listed, key=lambda r: r["commit"]):
            number, kind, removes = row["commit"], row["kind"], row["removes"] or []
            if kind == "overwrite":
                live = {}
            elif kind != "add":
                if row["base"] != last or not set(removes) <= set(live):
                    continue
                live = {n: k for n, k in live.items() if n not in removes}
            live[number] = kind
            if kind != "add":
                last = number
        deletions = tuple(n for n, kind in live.items() if kind == "delete")
        return _State(tuple(n for n in live if n not in deletions), deletions, last)

    def claim(self) -> int:
        """A number that no other writer has or gets."""
        number = max(self.numbers(), default=-1) + 1
        while True:
            claim = self._hadoop(_table(self.path, f"claims/{number}"))
            self._system.mkdirs(claim.getParent())
            try:
                created = self._system.createNewFile(claim)
            except Exception:  # some file systems raise where another writer was first
                created = False
                if not self._system.exists(claim):
                    raise
            if created:
                return number
            number += 1

    def commit(
        self, number: int, lengths: DataFrame, kind: str, base: int = -1, removes: tuple[int, ...] = (), delivery=None
    ) -> None:
        stream, sent = delivery or (None, None)
        removed = F.array(*[F.lit(n) for n in removes]).cast("array<int>")
        rows = lengths.coalesce(1).select(
            F.lit(number).alias("commit"), F.lit(kind).alias("kind"), F.lit(base).alias("base"), removed.alias("removes"),
            F.lit(stream).cast("string").alias("stream"), F.lit(sent).cast("bigint").alias("delivery"),
            F.lit(number).alias("batch"), "field", "n_docs", "total",
        )
        rows.write.parquet(_table(self.path, f"lengths/commit={number}"))


def index_exists(spark: SparkSession, path: str) -> bool:
    return _Log(spark, path).state() is not None


def _stored(spark: SparkSession, path: str, name: str, numbers: tuple[int, ...]) -> DataFrame:
    """Rows of a table in some batches; ``batch`` is the one that a document was added in."""
    folder = _table(path, name)
    rows = spark.read.option("basePath", folder).parquet(*[f"{folder}/batch={n}" for n in numbers])
    return rows.withColumn("batch", F.coalesce("home", "batch")).drop("home") if "home" in rows.columns else rows


def _deleted(spark: SparkSession, path: str, state: _State) -> DataFrame | None:
    return _stored(spark, path, "deleted", state.deletions).select(*DOCUMENT) if state.deletions else None


def _without(rows: DataFrame, deleted: DataFrame | None, fits: bool) -> DataFrame:
    if deleted is None:
        return rows
    return rows.join(F.broadcast(deleted) if fits else deleted, DOCUMENT, "left_anti")


def open_index(spark: SparkSession, path: str) -> FieldIndex:
    """Stored index as it is now. A batch whose writing was cut short is not listed and not read."""
    log = _Log(spark, path)
    state = log.state()
    if state is None:
        raise FileNotFoundError(f"no index at {path}")
    counted = state.batches + state.deletions
    deleted = _deleted(spark, path, state)
    fits = deleted is not None and fits_broadcast(deleted)
    docs, postings, blocks = (_stored(spark, path, name, state.batches) for name in ("docs", "postings", "blocks"))
    vocabulary = _stored(spark, path, "vocabulary", counted).groupBy("field", "term").agg(F.sum("df").alias("df"))
    return FieldIndex(
        docs=_without(docs, deleted, fits).select(*DOCUMENT).distinct(),
        postings=_without(postings, deleted, fits),
        vocabulary=vocabulary.where(F.col("df") > 0) if state.deletions else vocabulary,
        lengths=log.rows(list(counted)).select("field", "n_docs", "total"),
        saved=True,
        blocks=blocks,
    )


def _write(df: DataFrame, path: str, table: str, number: int) -> DataFrame:
    folder = f"{_table(path, table)}/batch={number}"
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _block_bounds(postings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(field, term, block, n, max_tf, min_length)`` of frequent terms."""
    frequent = vocabulary.where(F.col("df") >= FREQUENT).select("field", "term")
    frequent = F.broadcast(frequent) if fits_broadcast(frequent) else frequent
    return (
        postings.join(frequent, ["field", "term"], "left_semi")
        .groupBy("field", "term", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf"), F.min("length").alias("min_length"))
    )


def _write_terms(postings: DataFrame, vocabulary: DataFrame, path: str, number: int) -> None:
    """Vocabulary and blocks of a batch, by term."""
    by_term = vocabulary.repartitionByRange("term", "field")
    stored = _write(by_term.sortWithinPartitions("term", "field"), path, "vocabulary", number)
    _write(_block_bounds(postings, stored), path, "blocks", number)


def write_index(
    fields: DataFrame,
    path: str,
    mode: str = "create",
    analyzer: Callable[[Column], Column] = words_standard,
    delivery: tuple[str, int] | None = None,
    one_byte_lengths: bool = False,
) -> FieldIndex:
    """Write the index of ``fields`` and open it.

    ``create``     writes only if there is no index yet
    ``overwrite``  replaces an index
    ``append``     adds the documents, repeated ones too; int and bigint ids are moved past
                   the largest one stored; others stay, and are told apart by their batch
    ``read``       writes nothing

    ``append`` and ``read`` raise if there is no index; an empty corpus raises.

    Each call writes a batch folder in every table under a number that no other writer gets, and
    commits it last. Until then readers see the index as it was. Writers may append at the same time; of
    two that create an index at the same time both count. The batches that ``overwrite`` replaces are
    emptied afterwards. A ``delivery``, the name and number of what a stream sends, is committed with its batch;
    one that is already there writes nothing, so that sending it again does no harm.

    With ``one_byte_lengths`` postings score with lengths as :func:`~corpusloom.functions.scoring.one_byte_length` keeps
    them; averages stay exact. All calls for one index should say the same.
    """
    spark = fields.sparkSession
    if mode not in ("create", "overwrite", "append", "read"):
        raise ValueError(f"unknown index mode {mode!r}")
    log = _Log(spark, path)
    state = log.state()
    if mode in ("append", "read") and state is None:
        raise FileNotFoundError(f"no index at {path}")
    if mode == "read" or (mode == "create" and state is not None):
        return open_index(spark, path)
    if mode == "append" and delivery is not None:
        sent = (F.col("stream") == delivery[0]) & (F.col("delivery") == delivery[1])
        if not log.rows(log.numbers()).where(sent).isEmpty():
            return open_index(spark, path)
    batch = log.claim()

    if mode == "append" and dict(fields.dtypes)["doc_id"] in ("int", "bigint"):
        stored = _stored(spark, path, "docs", state.batches)
        next_id = stored.agg(F.coalesce(F.max("doc_id"), F.lit(-1)) + 1).first()[0]
        moved = (F.col("doc_id") + F.lit(next_id)).cast(fields.schema["doc_id"].dataType)
        fields = fields.withColumn("doc_id", moved)

    home = F.lit(batch).alias("home")
    docs = _write(document_lengths(fields, analyzer).select(home, "*"), path, "docs", batch)
    if docs.isEmpty():
        raise ValueError("no documents to index")
    # Ranges of the grouping keys: grouped and ordered in place after a single shuffle,
    # and a term that is in every document fills many ranges.
    keys = ["term", "field", "block", "doc_id", "length"]
    block = block_of(F.col("doc_id"), fields.schema["doc_id"].dataType)
    ranged = field_tokens(fields, analyzer).withColumn("block", block).repartitionByRange(*keys)
    sorted_postings = postings_of_tokens(ranged).sortWithinPartitions(*keys).select(home, "*")
    if one_byte_lengths:
        sorted_postings = sorted_postings.withColumn("length", one_byte_length(F.col("length")))
    with grouped_by_sorting(spark):
        postings = _write(sorted_postings, path, "postings", batch)
    # Counted from the stored postings, which are sorted by term: nearly all of the
    # counting happens before the shuffle.
    _write_terms(postings, postings.groupBy("field", "term").agg(F.count("*").alias("df")), path, batch)
    log.commit(batch, field_lengths(docs), "overwrite" if mode == "overwrite" else "add", delivery=delivery)
    if mode == "overwrite" and state is not None:
        for number in state.batches:
            for table in ("postings", "vocabulary", "docs", "blocks"):
                schema = spark.read.parquet(f"{_table(path, table)}/batch={number}").schema
                _write(spark.createDataFrame([], schema), path, table, number)
    return open_index(spark, path)


def delete_documents(spark: SparkSession, path: str, documents: DataFrame) -> FieldIndex:
    """Delete documents ``(doc_id)`` or ``(batch, doc_id)`` from a stored index and open it.

    Without ``batch`` all documents of an id go. What isn't there, and null ids, are ignored. The postings stay where they are until a
    merge and are left out by an anti-join; counts and lengths are those without the documents at once.
    """
    log = _Log(spark, path)
    while True:
        state = log.state()
        if state is None:
            raise FileNotFoundError(f"no index at {path}")
        index = open_index(spark, path)
        on = [c for c in DOCUMENT if c in documents.columns]
        wanted = documents.select(*on).where(F.col("doc_id").isNotNull()).distinct()
        hint = F.broadcast if fits_broadcast(wanted) else (lambda df: df)
        number = log.claim()
        gone = index.docs.join(hint(wanted), on, "left_semi").select(F.col("batch").alias("home"), "doc_id")
        gone = _write(gone, path, "deleted", number)
        if gone.isEmpty():
            return index
        named = gone.select(F.col("home").alias("batch"), "doc_id")
        named = F.broadcast(named) if fits_broadcast(named) else named
        fewer = index.postings.join(named, DOCUMENT, "left_semi").groupBy("field", "term").agg((-F.count("*")).alias("df"))
        _write(fewer, path, "vocabulary", number)
        lost = _stored(spark, path, "docs", state.batches).join(named, DOCUMENT, "left_semi")
        lengths = field_lengths(lost).select("field", (-F.col("n_docs")).alias("n_docs"), (-F.col("total")).alias("total"))
        log.commit(number, lengths, "delete", base=state.last)
        if number in log.state().deletions:
            return open_index(spark, path)


def merge_batches(spark: SparkSession, path: str, width: int = 4, everything: bool = False) -> FieldIndex:
    """Merge batches of about the same size into larger ones, and open the index.

    Batches are classed by the power of ``width`` of their number of documents; a class of ``width`` or more becomes one batch, and
    so on, so that an index has a few batches of each class however often it is appended to. With
    ``everything`` all batches and deletions become one. Documents keep the batch and id they are known by, and deleted
    ones are gone from what has been merged. Results stay the same, and additions may go on meanwhile; if another merge or
    deletion comes between, the work is done anew.
    """
    if width < 2:
        raise ValueError("width must be at least 2")
    log = _Log(spark, path)
    while True:
        state = log.state()
        if state is None:
            raise FileNotFoundError(f"no index at {path}")
        chosen = _mergeable(spark, path, state, width, everything)
        if not chosen:
            return open_index(spark, path)
        deleted = _deleted(spark, path, state)
        fits = deleted is not None and fits_broadcast(deleted)
        number = log.claim()
        batches = tuple(n for n in chosen if n in state.batches)

        def held(table: str) -> DataFrame:
            rows = _without(_stored(spark, path, table, batches), deleted, fits)
            return rows.withColumnRenamed("batch", "home")

        _write(held("docs"), path, "docs", number)
        keys = ["term", "field", "block", "home", "doc_id"]
        ranged = held("postings").repartitionByRange(*keys).sortWithinPartitions(*keys)
        postings = _write(ranged, path, "postings", number)
        # Documents that are deleted but not merged away by number are still taken off by their deletion.
        counts = _stored(spark, path, "vocabulary", chosen).groupBy("field", "term").agg(F.sum("df").alias("df"))
        _write_terms(postings, counts.where(F.col("df") != 0), path, number)
        lengths = log.rows(list(chosen)).groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("total").alias("total"))
        log.commit(number, lengths, "merge", base=state.last, removes=chosen)
        if everything and number in log.state().batches:
            return open_index(spark, path)


def _mergeable(spark: SparkSession, path: str, state: _State, width: int, everything: bool) -> tuple[int, ...]:
    """The batches to merge next: the smallest class with enough of them."""
    if everything:
        return state.batches + state.deletions if len(state.batches) + len(state.deletions) > 1 else ()
    sizes = _Log(spark, path).rows(list(state.batches)).groupBy("batch").agg(F.max("n_docs").alias("n"))
    classes: dict[int, list[int]] = {}
    for row in sizes.collect():
        power = 0
        while width ** (power + 1) <= max(row["n"], 1):
            power += 1
        classes.setdefault(power, []).append(row["batch"])
    full = [sorted(numbers) for _, numbers in sorted(classes.items()) if len(numbers) >= width]
    return tuple(full[0]) if full else ()
