"""Relevance scoring as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: BM25 term-frequency saturation and length normalisation ---------
K1 = 1.2
B = 0.75
# ----------------------------------------------------------------------------------


def bm25_idf(df: Column, n_docs: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_tf(tf: Column, length: Column, avg_length: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg_length))


def bm25(tf: Column, length: Column, df: Column, n_docs: Column, avg_length: Column) -> Column:
    """BM25 weight of one term in one document, with the exact document length."""
    return bm25_idf(df, n_docs) * bm25_tf(tf, length, avg_length)


def one_byte_length(length: Column) -> Column:
    """A document length as one byte can hold it: exact below 40, then rounded down to four significant bits beyond 24."""
    beyond = length - 24
    cut = F.greatest(F.length(F.bin(F.greatest(beyond, F.lit(0)).cast("bigint"))) - 4, F.lit(0))
    step = F.pow(F.lit(2.0), cut).cast("bigint")
    return F.when(length < 40, length).otherwise(24 + F.floor(beyond / step) * step).cast("int")
