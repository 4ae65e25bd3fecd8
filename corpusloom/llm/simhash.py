"""Near-duplicates by SimHash, found through deletion-variant signatures.

Texts whose 64-bit fingerprints differ in at most ``max_bits`` bits are linked. The
fingerprint is cut into segments, few enough that by the pigeonhole principle one segment
of a linked pair differs in at most one bit. Of each segment the index holds a variant
for each of its bits, with that bit blanked: two segments that differ in at most one bit
share a variant, so an equality join on variants meets every linked pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.joins import fits_broadcast
from .buckets import bucket_links
from .components import connected_components
from .tables import python_tasks, saved, whole_text

SHINGLE = 4
SEED = 42
MAX_BITS = 4
AT_ONCE = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in over half the hashes of the text's word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.diff(ends, prepend=0)
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1], ends[size - 1 :] - 1
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for low in range(0, len(starts), AT_ONCE):
        spans = zip(starts[low : low + AT_ONCE].tolist(), ends[low : low + AT_ONCE].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(votes * 2 > len(starts), bitorder="little")
    return int(chosen.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every whole text, as a signed bigint."""
    python_tasks(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.record_batch({"doc_id": batch["doc_id"], "fp": pa.array(found.view(np.int64))})

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    return chosen.mapInArrow(hashed, "doc_id bigint, fp bigint")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the segments: so many that one differs in at most one bit."""
    n = max_bits // 2 + 1
    edges = [round(64 * k / n) for k in range(n + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def variants(fp: Column, max_bits: int) -> Column:
    """Array of the one-wildcard variants of all segments, each marked with its place."""
    found, place = [], 0
    for low, width in _segments(max_bits):
        if width > 40:
            raise ValueError("max_bits is at least 2")
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            blanked = part.bitwiseAND(F.lit(~(1 << bit)))
            found.append(blanked.bitwiseOR(F.lit(place << 40)))
            place += 1
    return F.array(*found)


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: fingerprints, connected wherever they differ in at most ``max_bits`` bits.

    Equal fingerprints are one row here, so a text copied a million times costs nothing.
    A crowded variant is split into tiles (see ``buckets``); nothing is left out.
    """
    python_tasks(prints.sparkSession, 10_000)
    # A fixed number of tasks: few bytes go in, but every fingerprint becomes some sixty rows.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = (
        prints.select(F.col("fp").alias("id"))
        .distinct()
        .repartition(tasks)
        .select("id", F.explode(variants(F.col("id"), max_bits)).alias("bucket"))
    )

    def near(held: pa.Table):
        prints = held["id"].to_numpy()

        def test(i, j):
            return np.bitwise_count((prints[i] ^ prints[j]).view(np.uint64)) <= max_bits

        return test

    return bucket_links(index, near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id that can be reached through links. Null and empty
    texts have fingerprint zero and are linked like any other; texts of fewer words than
    a shingle hash as a whole. Rows repeated or with equal ids each get a row.
    A null id never is a component id unless its whole component has none. An empty table
    gives an empty result; other columns are not looked at.
    """
    prints = saved(fingerprints(docs, doc_id, text), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    reached = connected_components(fingerprint_links(prints, max_bits))
    placed = saved(
        classes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "classes",
    )
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each component.

    Of rows that repeat that id one stays. Rows without an id stay where no document of
    their component has one.
    """
    # How many rows of an id stay; the ids that go are few enough to be broadcast, or else those that stay are joined.
    decided = near_duplicates(docs, doc_id, text, max_bits).groupBy(F.col("doc_id").alias("_id")).agg(
        F.count_if(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("_rows")
    )
    decided = saved(decided, "kept")
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col("_id"))
    repeated = decided.where((F.col("_rows") > 1) & F.col("_id").isNotNull())
    other = decided.where((F.col("_rows") == 0) | ((F.col("_rows") > 1) & F.col("_id").isNotNull()))
    if fits_broadcast(other):
        single = docs.join(F.broadcast(other), same, "left_anti")
    else:
        single = docs.join(decided.where((F.col("_rows") == 1) | (F.col("_id").isNull() & (F.col("_rows") > 0))), same, "left_semi")
    if not repeated.head(1):
        return single
    return single.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates([doc_id]))
