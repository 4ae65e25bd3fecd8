"""Comparing the rows that share a bucket, whatever the size of the bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.joins import fits_broadcast

BLOCK = 512
PAIRS_AT_ONCE = 1 << 17


def tiled(index: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``tile``, ``side`` and ``own``: pieces of large buckets that can be compared apart.

    A bucket of at most ``block`` rows is one tile. A larger one is dealt into blocks by a
    hash of ``id``, and each pair of blocks is a tile (``own`` is false: only rows of
    different sides are compared), as is each block with itself. So every pair of rows
    of a bucket meets in exactly one tile, and a tile holds about two blocks of rows.
    The table of large buckets has at most ``rows / block`` rows; it is broadcast if
    it is measured to fit, and joined by a shuffle otherwise.
    """
    large = (
        index.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("held"))
        .where(F.col("held") > block)
        .select("bucket", F.ceil(F.col("held") / block).cast("int").alias("parts"))
    )
    joined = index.join(F.broadcast(large) if fits_broadcast(large) else large, "bucket", "left")
    side = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    tiles = F.when(
        F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("tile"), F.lit(0).alias("side"), F.lit(True).alias("own")))
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda other: F.struct(
                (F.least(side, other) * F.col("parts") + F.greatest(side, other)).cast("int").alias("tile"),
                side.alias("side"),
                (side == other).alias("own"),
            ),
        )
    )
    return joined.select(*index.columns, F.inline(tiles))


def _pairs(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs within runs, some at a time; ``start`` and ``end`` give each row's run."""
    rows = np.arange(len(start))
    partners = end - rows - 1
    total = np.cumsum(partners)
    low = 0
    while low < len(rows):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, "right")))
        some = partners[low:high]
        left = np.repeat(rows[low:high], some)
        first = np.cumsum(some) - some
        yield left, left + 1 + np.arange(len(left)) - np.repeat(first, some)
        low = high


def _settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked rows the smallest label among them, in place."""
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label[:] = label[label]
        differ = label[i] != label[j]
        i, j = i[differ], j[differ]


def whole_runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted batches as tables that never end within a run of equal ``names``."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[name].to_numpy() for name in names]
        differs = np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in columns]))
        cut = int(differs[-1]) + 1 if len(differs) else 0
        if rest and any(rest[-1][name][-1].as_py() != batch[name][0].as_py() for name in names):
            yield pa.Table.from_batches(rest)
            rest = []
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest)


Near = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], np.ndarray]


def bucket_links(
    index: DataFrame, near: Callable[[pa.Table], Near], weight: str | None = None, block: int = BLOCK
) -> DataFrame:
    """Rows ``(a, b, n)`` about rows of one bucket for which ``near`` holds.

    ``index`` has ``bucket`` and ``id`` (bigint) and what ``near`` reads: it is called with
    an Arrow table and returns a test for arrays of row numbers ``i`` and ``j``.
    Rows with ``b`` set link two ids; they connect whatever is linked, through at most
    one row for each id and tile, so a group of copies does not become all its pairs.
    With ``weight``, rows with null ``b`` add up that column over the links of ``a`` in a tile.
    The pairs themselves are formed in memory, a bounded number at a time.
    """
    tiles = tiled(index, block)
    dealt = tiles.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "id")

    def compare(held: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, tile = held["bucket"].to_numpy(), held["tile"].to_numpy()
        same = (bucket[1:] == bucket[:-1]) & (tile[1:] == tile[:-1])
        held = held.take(pa.array(np.flatnonzero(np.r_[same, False] | np.r_[False, same])))
        if not held.num_rows:
            return
        bucket, tile = held["bucket"].to_numpy(), held["tile"].to_numpy()
        ids, side = held["id"].to_numpy(), held["side"].to_numpy()
        own = held["own"].to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])])
        lengths = np.diff(np.r_[begins, len(ids)])
        test = near(held)
        label = np.arange(len(ids))
        links = np.zeros(len(ids), dtype=np.int64)
        weights = held[weight].to_numpy() if weight else None
        for i, j in _pairs(np.repeat(begins, lengths), np.repeat(begins + lengths, lengths)):
            meet = own[i] | (side[i] != side[j])
            i, j = i[meet], j[meet]
            linked = test(i, j)
            i, j = i[linked], j[linked]
            _settle(label, i, j)
            if weight:
                np.add.at(links, i, weights[j])
                np.add.at(links, j, weights[i])
        moved = np.flatnonzero(label != np.arange(len(ids)))
        counted = np.flatnonzero(links)
        a = np.r_[ids[moved], ids[counted]]
        b = pa.array(np.r_[ids[label[moved]], ids[counted]], mask=np.arange(len(a)) >= len(moved))
        n = np.r_[np.zeros(len(moved), dtype=np.int64), links[counted]]
        yield pa.record_batch({"a": pa.array(a), "b": b, "n": pa.array(n)})

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_runs(batches, ("bucket", "tile")):
            yield from compare(held)

    return dealt.mapInArrow(compared, "a bigint, b bigint, n bigint")
