"""Near-duplicate embeddings by binary codes of randomly rotated vectors.

A unit vector ``o`` is rotated by a random orthogonal matrix and replaced by the signs of
its coordinates, ``code / sqrt(D)``, together with the correction factor
``f = <code / sqrt(D), rotated o>``. For another unit vector ``q`` then
``<code / sqrt(D), rotated q> / f`` estimates ``<o, q>`` without bias, and
``BOUND * sqrt((1 - f^2) / f^2) / sqrt(D - 1)`` bounds its error. Pairs whose
upper bound stays below the threshold are dismissed; all others get the exact cosine in
double precision.

Codes, correction factors and the rotated vectors rounded to four bits, whose highest is the code, are worked out once and stored. What travels to the
buckets are these; keys and full vectors are joined only to rows that have an undecided partner in a bucket.

Candidates come from sign bits of further random projections: tables of keys of :func:`table_size` bits, which grow with the
number of vectors so that buckets don't. Two vectors of cosine c agree in a table of b bits with probability
``(1 - acos(c) / pi) ** b``; there are so many tables that a pair just at the threshold is missed
with probability ``MISSED`` at most: 48 tables of 12 bits at 0.93 up to 262,144 vectors, 109 of 18 bits at 16 million.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .buckets import _pairs, bucket_links, tiled, whole_runs
from .components import connected_components
from .tables import python_tasks, saved

THRESHOLD = 0.93
TABLES = 48
BITS = 12
MISSED = 1e-5
BOUND = 4.0
SEED = 20_011


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix; its rows are the new axes."""
    q, r = np.linalg.qr(np.random.default_rng((seed, size)).standard_normal((size, size)))
    return (q * np.sign(np.diag(r))).T


def projections(size: int, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng((seed, size, 1)).standard_normal((size, tables * bits))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Nonzero vectors scaled to length one; first by their largest component, so that squares stay finite."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def table_keys(unit: np.ndarray, tables: int, bits: int) -> np.ndarray:
    signs = (unit @ projections(unit.shape[1], tables, bits) > 0).reshape(-1, tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def table_size(vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Number of tables and bits of a key for so many vectors."""
    bits = min(30, max(BITS, round(math.log2(max(1, vectors))) - 6))
    agree = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return max(TABLES, math.ceil(math.log(MISSED) / math.log1p(-agree))) if agree < 1 else TABLES, bits


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit vectors, their sign codes and correction factors."""
    turned = unit @ rotation(unit.shape[1]).T
    code = np.where(turned > 0, 1.0, -1.0)
    return turned, code, np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def estimate(code: np.ndarray, factor: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products, row by row, and the half width of their interval."""
    size = code.shape[1]
    guess = np.einsum("ij,ij->i", code, other) / (np.sqrt(size) * factor)
    spread = np.sqrt(np.maximum(0, 1 - factor**2)) / factor / np.sqrt(max(1, size - 1))
    return guess, BOUND * spread


def packed_codes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotated vectors in four bits a coordinate, two to a byte, and the size of a step; the highest bit is the sign."""
    step = np.abs(turned).max(axis=1) / 7.999
    four = (np.floor(turned / step[:, None]) + 8).astype(np.uint8)
    if four.shape[1] % 2:
        four = np.pad(four, ((0, 0), (0, 1)))
    return four[:, ::2] << 4 | four[:, 1::2], step


def unpacked_codes(packed: np.ndarray, step: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes and rounded rotated vectors."""
    four = np.stack([packed >> 4, packed & 15], axis=2).reshape(len(packed), -1)[:, :size]
    return np.where(four >= 8, 1.0, -1.0), (four - 7.5) * step[:, None]


def stored_codes(classes: DataFrame, tables: int, bits: int) -> DataFrame:
    """``(id, label, copies, size, keys, code, factor, step)``: what is known of each vector but itself."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists = batch["vector"]
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy()
                begins = np.cumsum(sizes) - sizes
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    unit = unit_rows(flat[begins[at][:, None] + np.arange(size)].astype(float))
                    turned, _, factor = encode(unit)
                    code, step = packed_codes(turned)
                    keys = table_keys(unit, tables, bits)
                    places = np.arange(0, (len(at) + 1) * tables, tables, dtype=np.int32)
                    source = pa.array(at)
                    yield pa.record_batch(
                        {
                            "id": batch["id"].take(source),
                            "label": batch["label"].take(source),
                            "copies": batch["copies"].take(source),
                            "size": pa.array(np.full(len(at), size, dtype=np.int32)),
                            "keys": pa.ListArray.from_arrays(pa.array(places), pa.array(keys.reshape(-1))),
                            "code": pa.array([c.tobytes() for c in code], pa.binary()),
                            "factor": pa.array(factor.astype(np.float32)),
                            "step": pa.array(step.astype(np.float32)),
                        }
                    )

    schema = (
        "id bigint, label string, copies bigint, size int, keys array<int>, code binary, factor float, step float"
    )
    return saved(classes.select("id", "label", "vector", "copies").mapInArrow(rows, schema), "codes")


def indexed(codes: DataFrame) -> DataFrame:
    """``(bucket, id, table, size, code, factor, step)``: a row for each vector and table."""
    exploded = codes.select("*", F.posexplode("keys").alias("table", "key"))
    return exploded.select(
        F.xxhash64("label", "size", "table", "key").alias("bucket"), "id", "table", "size", "code", "factor", "step"
    )


class _Held:
    """The rows of an Arrow table of an index, and which of their pairs the codes leave undecided.

    Rounding a coordinate to four bits is off by less than half a step either way; the bound is widened by as
    many standard deviations of the sum of these as it has itself.
    """

    def __init__(self, held: pa.Table, threshold: float):
        self.threshold = threshold
        self.size = held["size"].to_numpy()
        self.factor, step = (held[c].to_numpy().astype(float) for c in ("factor", "step"))
        self.by_size = {}
        for n in np.unique(self.size):
            at = np.flatnonzero(self.size == n)
            packed = b"".join(held["code"].take(pa.array(at)).to_pylist())
            place = np.zeros(len(self.size), dtype=np.int64)
            place[at] = np.arange(len(at))
            signs, turned = unpacked_codes(np.frombuffer(packed, np.uint8).reshape(len(at), -1), step[at], int(n))
            self.by_size[int(n)] = at, place, signs, turned, BOUND * step[at] / np.sqrt(12)

    def undecided(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs whose upper bound reaches the threshold."""
        found = self.size[i] == self.size[j]
        for n, (_, place, signs, turned, rounding) in self.by_size.items():
            at = np.flatnonzero(found & (self.size[i] == n))
            p, q = place[i[at]], place[j[at]]
            factor = self.factor[i[at]]
            guess, width = estimate(signs[p], factor, turned[q])
            found[at] = guess + width + rounding[q] / factor >= self.threshold
        return found


class _Met:
    """Where pairs of a bucket meet first."""

    def __init__(self, held: pa.Table):
        self.label = np.unique(held["label"].to_numpy().astype(str), return_inverse=True)[1]
        self.table, self.key = held["table"].to_numpy(), held["key"].to_numpy()
        self.flat, self.begins = held["earlier"].combine_chunks().flatten().to_numpy(), np.r_[0, np.cumsum(self.table)]

    def here(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether pairs are of one label and table, and don't share a key of an earlier table."""
        first = (self.label[i] == self.label[j]) & (self.table[i] == self.table[j]) & (self.key[i] == self.key[j])
        for table in np.unique(self.table[i[first]]):
            at = np.flatnonzero(first & (self.table[i] == table))
            if table:
                a, b = (self.flat[self.begins[k[at]][:, None] + np.arange(table)] for k in (i, j))
                first[at] = ~(a == b).any(axis=1)
        return first


def _some_at_once(test, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parts = [test(i[low : low + (1 << 14)], j[low : low + (1 << 14)]) for low in range(0, len(i), 1 << 14)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=bool)


def rows_in_doubt(index: DataFrame, threshold: float) -> DataFrame:
    """``(bucket, id, table)`` of the rows that have an undecided partner in their bucket."""
    tiles = tiled(index)
    dealt = tiles.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ("bucket", "tile")):
            bucket, tile = table["bucket"].to_numpy(), table["tile"].to_numpy()
            same = (bucket[1:] == bucket[:-1]) & (tile[1:] == tile[:-1])
            table = table.take(pa.array(np.flatnonzero(np.r_[same, False] | np.r_[False, same])))
            if not table.num_rows:
                continue
            bucket, tile = table["bucket"].to_numpy(), table["tile"].to_numpy()
            own, side = table["own"].to_numpy(zero_copy_only=False), table["side"].to_numpy()
            begins = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])])
            lengths = np.diff(np.r_[begins, len(bucket)])
            held, doubt = _Held(table, threshold), np.zeros(len(bucket), dtype=bool)
            for i, j in _pairs(np.repeat(begins, lengths), np.repeat(begins + lengths, lengths)):
                meet = own[i] | (side[i] != side[j])
                i, j = i[meet], j[meet]
                open_pairs = _some_at_once(held.undecided, i, j)
                doubt[i[open_pairs]] = doubt[j[open_pairs]] = True
            kept = table.select(["bucket", "id", "table"]).filter(pa.array(doubt))
            yield from kept.to_batches()

    return dealt.mapInArrow(compared, "bucket bigint, id bigint, table int").distinct()


def vector_links(classes: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """``(a, b, n)`` as ``bucket_links`` gives it, over ``(id, label, vector, copies)`` rows.

    A pair that meets in several tables is looked at in the first of them only, so
    counts of links need no list of pairs.
    """
    kind = "<f4" if classes.schema["vector"].dataType.elementType.typeName() == "float" else "<f8"
    codes = stored_codes(classes, tables, bits)
    doubt = saved(rows_in_doubt(indexed(codes), threshold), "rows-in-doubt")
    known = codes.join(classes.select("id", "vector"), "id").join(doubt, "id")
    fetched = saved(
        known.select(
            "bucket", "id", "label", "copies", "size", "table", F.get("keys", F.col("table")).alias("key"),
            F.slice("keys", F.lit(1), F.col("table")).alias("earlier"), "code", "factor", "step", "vector",
        ),
        "fetched-vectors",
    )

    def near(held: pa.Table):
        rows, met = _Held(held, threshold), _Met(held)
        lists = held["vector"].combine_chunks()
        flat, sizes = lists.flatten().to_numpy().astype(kind), np.diff(lists.offsets.to_numpy())
        begins = np.cumsum(sizes) - sizes
        unit = {n: unit_rows(flat[begins[at][:, None] + np.arange(n)].astype(float)) for n, (at, *_) in rows.by_size.items()}

        def some(i, j):
            linked = met.here(i, j)
            at = np.flatnonzero(linked)
            linked[at] = rows.undecided(i[at], j[at])
            for n, (_, place, *_) in rows.by_size.items():
                at = np.flatnonzero(linked & (rows.size[i] == n))
                linked[at] = np.einsum("ij,ij->i", unit[n][place[i[at]]], unit[n][place[j[at]]]) >= threshold
            return linked

        return lambda i, j: _some_at_once(some, i, j)

    return bucket_links(fetched, near, weight="copies")


def near_duplicate_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tables: int | None = None,
    bits: int | None = None,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows are compared only with rows of an equal label that is not null. Vectors that
    are null, empty, zero, or hold null or non-finite components link with nothing, nor do
    vectors of unequal lengths link with each other. Equal vectors of a label are one class
    and are not compared again, yet count as links of each other. Rows with an equal ``vec_id`` are rows of their
    own: each counts the other, if they link, and both have the component's id. An empty table gives an empty result, other
    columns are not looked at. ``tables`` and ``bits`` are :func:`table_size` unless given.
    """
    python_tasks(vectors.sparkSession)
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    chosen = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<float>" if single else "array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.coalesce(finite & F.exists("vector", lambda x: x != 0.0), F.lit(False))
    )
    good = chosen.where(usable)
    classes = saved(
        good.groupBy("label", "vector")
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumn("id", F.monotonically_increasing_id()),
        "vectors",
    )
    many, wide = table_size(classes.count(), threshold)
    found = saved(vector_links(classes, threshold, tables or many, bits or wide), "vector-links")
    # A class stands for its rows: links count all copies on both sides.
    reached = connected_components(found.where(F.col("b").isNotNull()).select("a", "b"))
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    rooted = saved(
        classes.select("id", "first")
        .join(reached.select(F.col("node").alias("id"), "root"), "id", "left")
        .select("id", "first", F.coalesce("root", "id").alias("root")),
        "vector-classes",
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = (
        classes.select("id", "label", "vector", "copies")
        .join(links, "id", "left")
        .join(rooted.select("id", "root").join(smallest, "root"), "id")
        .select(
            "label",
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
            "component_id",
        )
    )
    linked = good.join(placed, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = chosen.where(~usable).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
