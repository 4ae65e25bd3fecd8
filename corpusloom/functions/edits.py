"""Edit distance with adjacent transpositions."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F


def _restricted_distance(a: str, b: str) -> int:
    """Insert / delete / substitute / swap neighbours, no substring edited twice."""
    before, above = None, list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        row = [i]
        for j, cb in enumerate(b, 1):
            best = min(above[j] + 1, row[-1] + 1, above[j - 1] + (ca != cb))
            if before and j > 1 and ca == b[j - 2] and a[i - 2] == cb:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, above = above, row
    return above[-1]


def _distances(terms: pd.Series, target: pd.Series) -> pd.Series:
    return pd.Series([_restricted_distance(a, b) for a, b in zip(terms, target)], dtype="int32")


def _swapped(target: str, swaps: int) -> set[str]:
    """``target`` after so many swaps of neighbours at places that don't touch."""
    found = {(target, 0)}
    for _ in range(swaps):
        found = {
            (text[:i] + text[i + 1] + text[i] + text[i + 2 :], i + 2)
            for text, low in found
            for i in range(low, len(text) - 1)
        }
    return {text for text, _ in found}


def could_be_within(term: Column, target: str, edits: int) -> Column:
    """Necessary test without Python: some swaps of the target, the other edits plain."""
    tests = [
        F.levenshtein(term, F.lit(text), edits - swaps) >= 0
        for swaps in range(edits + 1)
        for text in sorted(_swapped(target, swaps))
    ]
    return reduce(lambda a, b: a | b, tests)


def edit_distance(term: Column, target: Column) -> Column:
    """Exact distance; meant for the few terms :func:`could_be_within` lets through."""
    return F.pandas_udf(_distances, "int")(term, target)
