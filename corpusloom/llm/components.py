"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import saved


def _summary(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    return (
        edges.join(least, "a")
        .select(
            F.inline(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                )
            )
        )
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (bigint columns ``a`` and ``b``).

    ``root`` is the smallest node of the component; a root has a row too. Self links,
    nulls and repeats are ignored; no links give no rows. Each round shortens paths, so
    the number of rounds grows with the logarithm of the longest path. Minima are combined
    before the shuffle; the join on a node with very many neighbours is split by AQE.
    Every round ends in a written table.
    """
    edges = saved(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    seen = _summary(edges)
    while seen["n"]:
        edges = saved(_small_star(_large_star(edges)), "stars")
        now = _summary(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
