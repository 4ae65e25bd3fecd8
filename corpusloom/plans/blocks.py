"""Position blocks: bounded window partitions inside documents of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 1 << 16


def block_of(pos: Column, size: Column | int = BLOCK) -> Column:
    """Block number of a 1-based position."""
    return F.floor((pos - 1) / F.lit(size) if isinstance(size, int) else (pos - 1) / size)


def with_lookahead(
    df: DataFrame, reach: Column | int, block: int = BLOCK, pos: str = "pos"
) -> DataFrame:
    """Adds ``block`` and ``own``, so that a row sees the next ``reach`` positions.

    Rows near the start of a block are repeated in the block before it with
    ``own = false``: there they serve only as partners. A block is at least as long as
    the reach, hence a row appears at most twice and a block never holds more than
    ``2 * max(block, reach)`` positions.
    """
    reach = F.lit(reach) if isinstance(reach, int) else reach
    size = F.greatest(F.lit(block), reach)
    home = F.floor((F.col(pos) - 1) / size)
    offset = F.pmod(F.col(pos) - 1, size)
    placed = F.when(
        (home > 0) & (offset < reach),
        F.array(
            F.struct(home.alias("block"), F.lit(True).alias("own")),
            F.struct((home - 1).alias("block"), F.lit(False).alias("own")),
        ),
    ).otherwise(F.array(F.struct(home.alias("block"), F.lit(True).alias("own"))))
    return df.select("*", F.inline(placed))
