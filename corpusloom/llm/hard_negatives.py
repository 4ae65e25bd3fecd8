"""Hard negatives by exact integer inner products from subset-sum tables.

Components are scaled to integers. An anchor's dimensions are taken eight at a time; for each such group a
table holds the sums of all 256 subsets of the anchor's eight integers. A candidate is stored as the
bit planes of its integers in two's complement: the bits of one plane and eight
dimensions are a byte, and that byte is the place in the anchor's table. The sums of a plane's lookups are
shifted by the plane and added, the sign plane is taken away: 8 multiplications become one lookup, and the result is the
exact inner product.

Anchors meet all rows in blocks: candidates are dealt into cells, anchors into stripes, and each pair of cell and
stripe is one group of bounded size that hands on at most the best few rows of each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ship_package
from .tables import saved

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SCALE = 256
CELL_ROWS = 1 << 16
LEAST_CELLS = 24
STRIPE_ROWS = 1 << 12
TILE_ROWS, TILE_ANCHORS = 1 << 12, 64


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of rows of integers, as bytes of eight dimensions: ``(rows, planes, groups)``."""
    groups = -(-values.shape[1] // 8)
    found = np.zeros((len(values), planes, groups), dtype=np.uint8)
    for plane in range(planes):
        bits = ((values >> np.int64(min(plane, 63))) & 1).astype(np.uint8)
        found[:, plane] = np.packbits(bits, axis=1, bitorder="little")
    return found


def unpack(packed: np.ndarray, size: int) -> np.ndarray:
    """Inverse of :func:`pack`."""
    bits = np.unpackbits(packed, axis=2, count=size, bitorder="little").astype(np.int64)
    weights = np.int64(1) << np.arange(packed.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("npd,p->nd", bits, weights)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """``(groups, 256, anchors)``: sums of each anchor's integers over every subset of a group."""
    count, size = anchors.shape
    groups = -(-size // 8)
    padded = np.zeros((count, groups * 8), dtype=kind)
    padded[:, :size] = anchors
    tables = np.zeros((groups, 256, count), dtype=kind)
    for group in range(groups):
        for bit in range(8):
            half = 1 << bit
            tables[group, half : 2 * half] = tables[group, :half] + padded[:, 8 * group + bit]
    return tables


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """``(rows, anchors)``: inner products, from the highest plane down; int64 wraps back into range."""
    planes, groups = packed.shape[1:]
    total = np.zeros((len(packed), tables.shape[2]), dtype=tables.dtype)
    for plane in reversed(range(planes)):
        if plane < planes - 1:
            total += total
        for group in range(groups):
            looked_up = tables[group].take(packed[:, plane, group], axis=0)
            if plane == planes - 1:
                total -= looked_up
            else:
                total += looked_up
    return total


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    chosen = np.arange(len(score))
    if len(score) > k:
        chosen = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return chosen[np.lexsort((ids[chosen], -score[chosen]))[:k]]


def packed_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, anchor, size, planes, packed)`` of ``(vec_id, label, anchor, vector)`` rows.

    A row is left out if its integers could give a score beyond a bigint: if one of its D
    components reaches ``sqrt(2^63 / D)`` when scaled.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                lists = batch["vector"]
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy()
                begins = np.cumsum(sizes) - sizes
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    with np.errstate(over="ignore"):
                        scaled = np.floor(flat[begins[at][:, None] + np.arange(size)] * scale)
                    high = np.abs(scaled).max(axis=1, initial=0)
                    fits = high < np.sqrt(2.0**63 / max(1, size)) - 1
                    at, integers, high = at[fits], scaled[fits].astype(np.int64), high[fits]
                    needed = np.ceil((np.ceil(np.log2(high + 1)) + 1) / 3).astype(int) * 3
                    for planes in np.unique(needed):
                        these = np.flatnonzero(needed == planes)
                        bits = pack(integers[these], int(planes))
                        source = pa.array(at[these])
                        yield pa.record_batch(
                            {
                                "vec_id": batch["vec_id"].take(source),
                                "label": batch["label"].take(source),
                                "anchor": batch["anchor"].take(source),
                                "size": pa.array(np.full(len(these), size, dtype=np.int32)),
                                "planes": pa.array(np.full(len(these), planes, dtype=np.int32)),
                                "packed": pa.array([b.tobytes() for b in bits], pa.binary()),
                            }
                        )

    return vectors.mapInArrow(
        rows, "vec_id bigint, label string, anchor boolean, size int, planes int, packed binary"
    )


def _bits(held: pa.Table, at: np.ndarray, size: int, planes: int) -> np.ndarray:
    joined = b"".join(held["packed"].take(pa.array(at)).to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(at), planes, -(-size // 8))


def _integers(held: pa.Table, at: np.ndarray, size: int) -> np.ndarray:
    planes = held["planes"].to_numpy()[at]
    found = np.zeros((len(at), size), dtype=np.int64)
    for n in np.unique(planes):
        these = np.flatnonzero(planes == n)
        found[these] = unpack(_bits(held, at[these], size, int(n)), size)
    return found


def all_scores(rows: pa.Table, anchors: pa.Table, row_at: np.ndarray, anchor_at: np.ndarray, size: int) -> np.ndarray:
    """``(anchors, rows)`` of inner products of the chosen rows of two tables, of equal dimensions."""
    integers = _integers(anchors, anchor_at, size)
    planes = rows["planes"].to_numpy()[row_at]
    bound = np.abs(integers).sum(axis=1).max(initial=0) << max(0, int(planes.max(initial=1)) - 1)
    kind = np.int32 if 0 <= bound < 1 << 31 and planes.max(initial=1) < 31 else np.int64
    tables = subset_sums(integers, kind)
    found = np.empty((len(anchor_at), len(row_at)), dtype=kind)
    for n in np.unique(planes):
        these = np.flatnonzero(planes == n)
        for low in range(0, len(these), TILE_ROWS):
            some = these[low : low + TILE_ROWS]
            found[:, some] = scores(tables, _bits(rows, row_at[some], size, int(n))).T
    return found


def _codes(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Labels of both tables as equal small integers."""
    both = pa.concat_arrays([*rows["label"].chunks, *anchors["label"].chunks]).dictionary_encode().indices.to_numpy()
    return both[: rows.num_rows], both[rows.num_rows :]


def _tiles(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(size, places of rows, places of some anchors)`` of equal dimensions."""
    row_size, anchor_size = rows["size"].to_numpy(), anchors["size"].to_numpy()
    for size in np.unique(anchor_size):
        row_at, anchor_at = np.flatnonzero(row_size == size), np.flatnonzero(anchor_size == size)
        if len(row_at):
            for low in range(0, len(anchor_at), TILE_ANCHORS):
                yield int(size), row_at, anchor_at[low : low + TILE_ANCHORS]


def _positives(k: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = _Out("anchor", "positive_id", "positive_score")
        row_label, anchor_label = _codes(rows, anchors)
        ids, place = rows["vec_id"].to_numpy(), rows["row"].to_numpy()
        own = anchors["row"].to_numpy()
        for label in np.unique(anchor_label):
            same = pa.array(np.flatnonzero(row_label == label))
            alike = pa.array(np.flatnonzero(anchor_label == label))
            few, some = rows.take(same), anchors.take(alike)
            for size, row_at, anchor_at in _tiles(few, some):
                found = all_scores(few, some, row_at, anchor_at, size)
                held = same.to_numpy()[row_at]
                for n, anchor in enumerate(own[alike.to_numpy()[anchor_at]]):
                    others = np.flatnonzero(place[held] != anchor)
                    score = found[n, others].astype(np.int64)
                    top = best(score, ids[held[others]], k)
                    out.add(len(top), anchor, ids[held[others[top]]], score[top])
        return out.table()

    return find


def _negatives(k: int, low: int, high: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = _Out("anchor", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")
        row_label, anchor_label = _codes(rows, anchors)
        ids = rows["vec_id"].to_numpy()
        own, names, lists = anchors["row"].to_numpy(), anchors["vec_id"].to_numpy(), anchors["positives"].to_pylist()
        for size, row_at, anchor_at in _tiles(rows, anchors):
            found = all_scores(rows, anchors, row_at, anchor_at, size)
            for n, at in enumerate(anchor_at):
                differ = np.flatnonzero(row_label[row_at] != anchor_label[at])
                score, other = found[n, differ].astype(np.int64), ids[row_at[differ]]
                for place, positive in enumerate(lists[at]):
                    above, below = -(-low * positive["score"] // 100), high * positive["score"] // 100
                    band = np.flatnonzero((score >= above) & (score <= below))
                    top = band[best(score[band], other[band], k)]
                    out.add(
                        len(top), own[at], names[at], place, positive["id"], positive["score"], other[top], score[top]
                    )
        return out.table()

    return find


class _Out:
    """Columns of bigints, a few rows at a time."""

    def __init__(self, *names: str):
        self.columns: dict[str, list[np.ndarray]] = {name: [] for name in names}

    def add(self, count: int, *values) -> None:
        for column, value in zip(self.columns.values(), values):
            column.append(np.broadcast_to(np.asarray(value, dtype=np.int64), count))

    def table(self) -> pa.Table:
        empty = [np.zeros(0, dtype=np.int64)]
        return pa.table({name: pa.array(np.concatenate(empty + parts)) for name, parts in self.columns.items()})


def _in_blocks(rows: DataFrame, anchors: DataFrame, cells: int, stripes: int, find, schema: str) -> DataFrame:
    """``find`` over every block: a cell of rows and a stripe of anchors."""

    def dealt(df: DataFrame, by: str, parts: int, all_of: str, others: int) -> DataFrame:
        return df.select(
            "*",
            F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias(by),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(all_of),
        )

    left = dealt(rows, "cell", cells, "stripe", stripes).groupBy("cell", "stripe")
    right = dealt(anchors, "stripe", stripes, "cell", cells).groupBy("cell", "stripe")
    return left.cogroup(right).applyInArrow(find, schema)


def mine(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows where ``anchor`` holds.

    A component x counts as ``floor(scale * x)``, a score is an integer inner product; higher ones come first,
    ties by smaller id. Positives are an anchor's first ``positives`` other rows of its label. For each of
    them the first ``negatives`` rows of other labels are returned whose score is at least ``low`` and at most ``high``
    percent of the positive's; a negative positive score therefore gives none.

    Rows with a null id, label, vector or component, or a non-finite component take no part, nor do rows with
    integers so large that a score need not fit a bigint (:func:`packed_rows`); only vectors of equal length are
    compared. Repeated rows and ids are rows of their own: each repeated anchor has its results, a copy of an
    anchor can be its positive. An empty table gives an empty result; other columns are not looked at.

    The work is anchors times rows. A block holds about ``CELL_ROWS`` rows and ``STRIPE_ROWS`` anchors whatever the size
    of the table or of a label, and returns at most ``positives * negatives`` rows for each anchor.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    chosen = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    rows = saved(
        packed_rows(chosen.where(usable), scale).withColumn("row", F.monotonically_increasing_id()), "packed-vectors"
    )
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).first()
    cells = max(LEAST_CELLS, -(-counts["n"] // CELL_ROWS))
    stripes = max(1, -(-counts["anchors"] // STRIPE_ROWS))
    candidates = rows.drop("anchor")
    anchors = rows.where("anchor").drop("anchor")

    near = _in_blocks(
        candidates, anchors, cells, stripes, _positives(positives), "anchor bigint, positive_id bigint, positive_score bigint"
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    top = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    listed = F.struct("place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    lists = top.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(listed)).alias("positives"))
    pairs = saved(anchors.join(lists, "row"), "anchors")

    schema = ", ".join(
        f"{name} bigint"
        for name in ("anchor", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")
    )
    found = _in_blocks(candidates, pairs, cells, stripes, _negatives(negatives, low, high), schema)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
