"""Benchmark decontamination by a broadcast set of test windows; built-in functions only.

Words are runs of digits, letters a-z (A-Z is lowered) and all characters beyond ASCII. A
window is ``size`` consecutive words of a benchmark item; a shorter item, unless it has no
words, is one window. The distinct windows, keyed by a 64-bit hash, are joined with
the hashes of all windows of the documents, and a hit counts only if its words are equal.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.joins import fits_broadcast, join_on_small
from .tables import saved

SIZE = 10
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TAIL = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*$"


def words(text: Column) -> Column:
    held = F.coalesce(text, F.lit(""))
    # Only A-Z is lowered; where all is ASCII that is what the faster function does.
    lowered = F.when(F.octet_length(held) == F.char_length(held), F.lower(held)).otherwise(
        F.translate(held, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def test_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``(key, width, window, items)``: the distinct windows and the items that hold them."""
    held = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(size))
    found = held.select(
        "item",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - width + 1), lambda i: F.slice("words", i, width)
            )
        ).alias("window"),
    )
    return found.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("window").alias("key"), F.size("window").alias("width"), "window", "items"
    )


def _tokenized(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
        words(F.col(text)).alias("words"),
    )


def _places(tokenized: DataFrame, lead: int) -> DataFrame:
    """A row for each place where ``lead`` words begin, with their hash, and one with ``pos`` 0."""
    last = F.size("words") - (lead - 1)
    found = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.xxhash64(*[F.get("words", i + (k - 1)) for k in range(lead)]),
    )
    hashes = F.when(last >= 1, found).otherwise(F.array().cast("array<bigint>"))
    # The outer form keeps Catalyst from adding a filter that would tokenize again.
    whole = F.array(F.lit(None).cast("bigint"))
    return tokenized.select(
        "doc", "text_hash", "words", F.posexplode_outer(F.concat(whole, hashes)).alias("pos", "lead")
    )


def _windows_at(places: DataFrame, widths: list[int]) -> DataFrame:
    """A row for each window that begins at a place; the row with ``pos`` 0 stays."""
    held = F.array(
        *[
            F.when(
                (F.col("pos") > 0) & (F.col("pos") + (n - 1) <= F.size("words")),
                F.struct(F.lit(n).alias("width"), F.xxhash64(F.slice("words", F.greatest("pos", F.lit(1)), n)).alias("key")),
            )
            for n in widths
        ]
    )
    held = F.filter(held, lambda w: w.isNotNull()) if len(widths) > 1 else held
    return places.select("doc", "text_hash", "words", "pos", F.inline_outer(held))


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
) -> DataFrame:
    """``(doc, text_hash, n_words, n_hit, items, spans)`` for every distinct (id, text) of ``docs``.

    ``spans`` are the hit windows as ``(pos, last)`` word numbers from 1, ``n_hit`` the
    words inside any of them, ``items`` the distinct item ids. One scan of the documents:
    their windows are tested against the broadcast table of test windows while they are
    formed. If that table is measured not to fit, they go through a shuffle join, salted by
    position so that a passage of very many documents is spread. Hits are then gathered
    for each document, which bounds them by its length. Null texts have no words, a null
    id is an id, equal rows count once; empty tables give no rows or no hits. Other columns
    are not looked at.
    """
    windows = test_windows(items, item_id, item_text, size)
    # Only items shorter than a window add widths: at most ``size`` numbers.
    widths = sorted(r.width for r in windows.select("width").distinct().limit(size).collect())
    lead = 1 if widths[:1] == [1] else 2
    places = _places(_tokenized(docs, doc_id, text), lead)
    small = windows.withColumnRenamed("width", "window_width")
    if not widths:
        met = places.where(F.col("pos") == 0).withColumns({"width": F.lit(0), "items": F.array().cast("array<int>")})
    elif fits_broadcast(windows):
        # Windows are hashed only where their first words begin a test window.
        leads = windows.select(F.xxhash64(*[F.get("window", F.lit(k)) for k in range(lead)]).alias("lead")).distinct()
        begun = places.join(F.broadcast(leads.withColumn("begins", F.lit(True))), "lead", "left")
        rows = _windows_at(begun.where((F.col("pos") == 0) | F.col("begins")), widths)
        joined = rows.join(F.broadcast(small), "key", "left")
        sure = F.slice("words", F.greatest("pos", F.lit(1)), F.coalesce("width", F.lit(1))) == F.col("window")
        met = joined.where((F.col("pos") == 0) | (F.col("window").isNotNull() & sure))
    else:
        carried = _windows_at(places.where(F.col("pos") > 0), widths).select(
            "doc", "text_hash", "pos", "width", "key", F.slice("words", "pos", F.coalesce("width", F.lit(1))).alias("held")
        )
        hit = join_on_small(carried, small, ["key"], salt_by=["doc", "pos"], small_fits=False)
        met = places.where(F.col("pos") == 0).unionByName(hit.where(F.col("held") == F.col("window")), True)
    gathered = met.groupBy("doc", "text_hash").agg(
        F.max(F.when(F.col("pos") == 0, F.size("words"))).cast("bigint").alias("n_words"),
        F.sort_array(
            F.collect_set(
                F.when(F.col("pos") > 0, F.struct("pos", (F.col("pos") + F.col("width") - 1).alias("last")))
            )
        ).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("last")),
        lambda acc, span: F.struct(
            (acc["n"] + F.greatest(F.lit(0), span["last"] - F.greatest(acc["last"], span["pos"] - 1))).alias("n"),
            F.greatest(acc["last"], span["last"]).alias("last"),
        ),
        lambda acc: acc["n"].cast("bigint"),
    )
    return gathered.select("doc", "text_hash", "n_words", covered.alias("n_hit"), "items", "spans")


def _hit_rows(docs: DataFrame, found: DataFrame, doc_id: str, text: str, how: str) -> DataFrame:
    same = docs[doc_id].eqNullSafe(found["doc"]) & (
        F.xxhash64(F.coalesce(docs[text], F.lit(""))) == found["text_hash"]
    )
    return docs.join(found, same, how)


def remove_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a test window."""
    found = find_hits(docs, items, doc_id, text, **options).where(F.col("n_hit") > 0)
    found = saved(found.select("doc", "text_hash"), "hit-documents")
    return _hit_rows(docs, F.broadcast(found) if fits_broadcast(found) else found, doc_id, text, "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with hit words, and what separates them from the word before, cut out."""
    found = find_hits(docs, items, doc_id, text, **options).where(F.col("n_hit") > 0)
    hit = found.select("doc", "text_hash", F.col("spans").alias("_spans"))
    joined = _hit_rows(docs, hit, doc_id, text, "left")
    kept = F.filter(
        F.regexp_extract_all(F.col(text), F.lit(_PIECE), F.lit(0)),
        lambda piece, i: ~F.exists("_spans", lambda s: (s["pos"] <= i + 1) & (i + 1 <= s["last"])),
    )
    cleaned = F.when(
        F.col("_spans").isNotNull(), F.concat(F.array_join(kept, ""), F.regexp_extract(text, _TAIL, 0))
    ).otherwise(F.col(text))
    return joined.select(*[cleaned.alias(c) if c == text else docs[c] for c in docs.columns])
