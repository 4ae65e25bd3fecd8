"""Passages that repeat across documents, by a sparse suffix array over words.

Of the suffixes of all texts only those at minimisers are kept: every window of
``min_words`` words selects, by its content alone, the position of the smallest hash among
its first ``spread`` word groups. Equal windows select the same place, so the suffixes that
start there agree in their first ``min_words - spread + 1`` words and are neighbours once
suffixes are sorted by these words. Neighbours that agree are extended: a suffix
carries hashes of the windows that selected it, which reach from 0 to ``spread - 1`` words left
of it to as far right as a window goes. A window found in two documents is a
match, and matches that overlap or touch make up a repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.joins import fits_broadcast
from .buckets import whole_runs
from .tables import python_tasks, saved, whole_text

MIN_WORDS = 50
SPREAD = 30
GROUP = 10
#: Suffixes of one key that a task compares in memory: some twenty megabytes.
CROWD = 1 << 16
PROBE = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Windows:
    """Hashes of all runs of a number of words: a polynomial in the words' hashes, modulo 2^64."""

    def __init__(self, words: list[bytes]):
        digest = xxhash.xxh64_intdigest
        hashed = np.fromiter(map(digest, words), np.uint64, len(words))
        self.total = np.r_[np.uint64(0), np.cumsum(hashed * _powers(_BASE, len(words)), dtype=np.uint64)]
        self.back = _powers(_BACK, len(words))

    def of(self, size: int) -> np.ndarray:
        runs = (self.total[size:] - self.total[:-size]) * self.back[: len(self.total) - size]
        runs ^= runs >> np.uint64(31)
        return runs * _MIX


def sparse_suffixes(text: str, min_words: int, spread: int, group: int):
    """Per kept suffix: key, first window, how far left that reaches; and all window hashes.

    Returns ``(keys, firsts, lefts, hashes)``: windows ``firsts[k]`` to ``firsts[k + 1] - 1``
    selected suffix ``k``.
    """
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words) - min_words + 1
    if n < 1:
        return None
    hashed = _Windows(words)
    groups = hashed.of(group)[: n + spread - 1]
    chosen = np.arange(n) + np.lib.stride_tricks.sliding_window_view(groups, spread).argmin(axis=1)
    firsts = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    keys = hashed.of(min_words - spread + 1)[chosen[firsts]]
    return keys.view(np.int64), firsts, chosen[firsts] - firsts, hashed.of(min_words)


def suffix_table(docs: DataFrame, min_words: int, spread: int, group: int, keys_only: bool = False) -> DataFrame:
    """``(key, doc, first, left, windows)``: the kept suffixes; ``windows`` packs 64-bit hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, room = [], 0
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"]):
                found = sparse_suffixes(text.as_py(), min_words, spread, group)
                if found:
                    held.append((doc, *found))
                    room += len(found[3])
                    if room > 1 << 20:
                        yield packed(held)
                        held, room = [], 0
            if held:
                yield packed(held)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        keys = pa.array(np.concatenate([h[1] for h in held]))
        if keys_only:
            return pa.record_batch({"key": keys})
        many = [len(h[1]) for h in held]
        shift = np.cumsum([0, *[len(h[4]) for h in held]])
        starts = np.concatenate([h[2] + s for h, s in zip(held, shift)])
        offsets = (8 * np.r_[starts, shift[-1]]).astype(np.int32)
        data = np.concatenate([h[4] for h in held])
        windows = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return pa.record_batch(
            {
                "key": keys,
                "doc": pa.array(np.repeat(np.array([h[0] for h in held], dtype=np.int64), many)),
                "first": pa.array(np.concatenate([h[2] for h in held]).astype(np.int32)),
                "left": pa.array(np.concatenate([h[3] for h in held]).astype(np.int32)),
                "windows": windows,
            }
        )

    schema = "key bigint" if keys_only else "key bigint, doc bigint, first int, left int, windows binary"
    return docs.mapInArrow(rows, schema)


def _shared(held: pa.Table) -> Iterator[pa.RecordBatch]:
    """Ranges of windows that another document has, among suffixes sorted by their keys."""
    key = held["key"].to_numpy()
    same = key[1:] == key[:-1]
    held = held.take(pa.array(np.flatnonzero(np.r_[same, False] | np.r_[False, same])))
    if not held.num_rows:
        return
    key, doc = held["key"].to_numpy(), held["doc"].to_numpy()
    first, left = held["first"].to_numpy(), held["left"].to_numpy()
    packed = held["windows"].to_pylist()
    many = np.fromiter(map(len, packed), np.int64, len(packed)) // 8
    row = np.repeat(np.arange(len(key)), many)
    step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    window = np.frombuffer(b"".join(packed), dtype=np.int64)
    run = np.cumsum(np.r_[True, key[1:] != key[:-1]])[row]
    order = np.lexsort((doc[row], window, left[row] - step, run))
    r, w, reach, d = run[order], window[order], (left[row] - step)[order], doc[row][order]
    begins = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (w[1:] != w[:-1]) | (reach[1:] != reach[:-1])])
    size = np.diff(np.r_[begins, len(order)])
    lowest, highest = d[begins], d[begins + size - 1]
    met = np.zeros(len(order), dtype=np.int8)  # 1: in its first document, 2: in a later one
    met[order] = np.where(np.repeat(lowest != highest, size), 1 + (d > np.repeat(lowest, size)), 0)
    # Neighbouring windows of a suffix with the same outcome are one range.
    cuts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (met[1:] != met[:-1])])
    ends = np.r_[cuts[1:], len(row)]
    at = np.flatnonzero(met[cuts] > 0)
    cuts, ends = cuts[at], ends[at]
    yield pa.record_batch(
        {
            "doc": pa.array(doc[row[cuts]]),
            "later": pa.array(met[cuts] == 2),
            "first": pa.array((first[row] + step)[cuts].astype(np.int64)),
            "last": pa.array((first[row] + step)[ends - 1].astype(np.int64)),
        }
    )


_RANGES = "doc bigint, later boolean, first bigint, last bigint"


def shared_ranges(docs: DataFrame, min_words: int, spread: int, group: int, crowd: int = CROWD) -> DataFrame:
    """Ranges of window starts that occur in another document too.

    Suffixes are sorted by key within hash partitions and compared key by key. Keys with very
    many suffixes are found on a sixteenth of the documents, which decides only how they are
    handled: their windows become rows of their own, whose smallest and largest document
    are aggregated, with partial results before the shuffle, and joined back.
    """
    sampled = docs.where(F.pmod(F.xxhash64("doc"), F.lit(PROBE)) == 0)
    crowded = saved(
        suffix_table(sampled, min_words, spread, group, keys_only=True)
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > crowd // PROBE)
        .select("key"),
        "crowded",
    )
    suffixes = suffix_table(docs, min_words, spread, group)
    if not crowded.head(1):
        usual, rest = suffixes, None
    else:
        known = F.broadcast(crowded) if fits_broadcast(crowded) else crowded
        usual, rest = suffixes.join(known, "key", "left_anti"), suffixes.join(known, "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_runs(batches, ("key",)):
            yield from _shared(held)

    found = usual.repartition("key").sortWithinPartitions("key").mapInArrow(compare, _RANGES)
    if rest is None:
        return found
    windows = saved(
        rest.select(
            "key",
            "doc",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.octet_length("windows"), F.lit(8)),
                    lambda i: F.hex(F.col("windows").substr(i, F.lit(8))),
                )
            ).alias("step", "window"),
            "first",
            "left",
        ).select(
            "key", "doc", (F.col("first") + F.col("step")).cast("bigint").alias("first"),
            (F.col("left") - F.col("step")).alias("reach"), F.conv("window", 16, -10).cast("bigint").alias("window"),
        ),
        "crowded-windows",
    )
    same = ["key", "reach", "window"]
    ends = windows.groupBy(*same).agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    met = windows.join(ends, same).select(
        "doc", (F.col("doc") > F.col("low")).alias("later"), "first", F.col("first").alias("last")
    )
    return found.unionByName(met)


def repeated_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    spread: int = SPREAD,
    group: int = GROUP,
) -> DataFrame:
    """``(doc_id, later, start, n_words)``: maximal runs of words inside windows of ``min_words``
    words that occur in two or more documents.

    Words are cut at ASCII white space; ``start`` counts words from 0. ``later`` is true
    for what a document of a smaller id has too, and false for what this document has first; removing
    the later passages leaves one copy. Passages that repeat only inside one document, or
    in rows of equal ids, don't count. Null texts have no words, rows with a null id are
    passed over, an empty table gives no rows; other columns are not looked at.
    """
    if spread + group > min_words + 1:
        raise ValueError("spread and group are too long for min_words")
    python_tasks(docs.sparkSession)
    chosen = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("bigint").alias("doc"), whole_text(text).alias("text")
    )
    found = shared_ranges(chosen, min_words, spread, group).withColumn("stop", F.col("last") + min_words)
    # Passages of a document: a range that starts after all earlier ones have stopped begins a new one.
    order = Window.partitionBy("doc", "later").orderBy("first", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = found.withColumn("new", F.coalesce((F.col("first") > before).cast("int"), F.lit(1)))
    numbered = begun.withColumn("passage", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy("doc", "later", "passage")
        .agg(F.min("first").alias("start"), F.max("stop").alias("stop"))
        .select(F.col("doc").alias("doc_id"), "later", "start", (F.col("stop") - F.col("start")).alias("n_words"))
    )
