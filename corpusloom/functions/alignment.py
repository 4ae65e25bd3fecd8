"""Phrases with slop: how well the positions of their words line up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def phrase_frequency(words: Column, slop: Column | int = 0) -> Column:
    """How often words stand together, each match counted ``1 / (1 + moves)``.

    ``words`` are ``array<struct<slot, offset, positions>>``, one for each word of the phrase, slots from 0 in order
    of the offsets. Positions are moved back by their word's offset, so that words in place are equal. A match is
    one position of each word; its moves are the greatest less the least of them, at most ``slop``. It
    begins with some word's position, takes the next position of every other word, and counts unless the first word has a
    later position that isn't beyond the others. No token is two words of a match.

    All positions are looked at once, from the last to the first; what is kept is the next position of each word.
    """
    slop = F.lit(slop) if isinstance(slop, int) else slop
    events = F.flatten(
        F.transform(
            words,
            lambda w: F.transform(
                w["positions"],
                lambda p: F.struct((p - w["offset"]).alias("at"), w["slot"].alias("slot"), p.alias("pos")),
            ),
        )
    )
    nothing = F.lit(None).cast("struct<at:int,pos:int>")
    start = F.struct(F.transform(words, lambda _: nothing).alias("next"), F.lit(0.0).alias("found"))

    def step(held: Column, event: Column) -> Column:
        others = F.filter(held["next"], lambda _, slot: slot != event["slot"])
        own = F.get(held["next"], event["slot"])
        nearest = F.array_min(F.transform(others, lambda n: n["at"]))
        moves = F.array_max(F.transform(others, lambda n: n["at"])) - event["at"]
        counts = (
            F.forall(others, lambda n: n.isNotNull() & (n["pos"] != event["pos"]))
            & (moves <= slop)
            & (own.isNull() | (own["at"] > nearest))
        )
        here = F.struct(event["at"].cast("int").alias("at"), event["pos"].cast("int").alias("pos"))
        return F.struct(
            F.transform(held["next"], lambda n, slot: F.when(slot == event["slot"], here).otherwise(n)).alias("next"),
            (held["found"] + F.when(counts, 1 / (1 + moves)).otherwise(0.0)).alias("found"),
        )

    swept = F.aggregate(F.reverse(F.array_sort(events)), start, step, lambda held: held["found"])
    return F.when(F.size(words) == 1, F.size(words[0]["positions"]).cast("double")).otherwise(swept)
