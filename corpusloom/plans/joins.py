"""Equi-joins against a side that is usually, but not provably, small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
SALTS = 16


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` (row count and string bytes); reads at most ``max_rows + 1`` rows."""
    width = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
    measured = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size"))
        .first()
    )
    return measured["n"] <= max_rows and (measured["size"] or 0) <= max_bytes


def join_on_small(
    large: DataFrame,
    small: DataFrame,
    on: list[str],
    *,
    salt_by: list[str],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    small_fits: bool | None = None,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join; broadcasts ``small`` when measured to fit, else a salted shuffle join.

    In the shuffle join every row of ``large`` gets one of :data:`SALTS` salts from its
    ``salt_by`` columns and ``small`` is repeated once per salt, so one hot key is
    spread over that many tasks. Both ways return the same rows. ``small_fits`` passes on
    a measurement already made.
    """
    if small_fits is None:
        small_fits = fits_broadcast(small, max_rows, max_bytes)
    if small_fits:
        return large.join(F.broadcast(small), on, how)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)))
    repeated = small.withColumn(
        "_salt", F.explode(F.array(*[F.lit(s).cast("bigint") for s in range(SALTS)]))
    )
    return salted.join(repeated.hint("shuffle_merge"), [*on, "_salt"], how).drop("_salt")
