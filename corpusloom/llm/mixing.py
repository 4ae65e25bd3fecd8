"""Mixing sources to target weights by Pfair scheduling; built-in functions only.

Target weights give each source a quota of characters (:func:`shares`): with ``epochs`` every row is used, and
rows of short sources are repeated. Each source is laid out in a fixed random order, again for each epoch, and cut
into blocks of ``block_chars`` characters. A source with a quota of ``size`` of all ``total`` characters of the mix has the
weight ``size / total``, not rounded. Its block ``i`` (from 1) is released at slot
``floor((i - 1) * total / size)`` and due before slot ``ceil(i * total / size)``; each slot goes to
the released block that is due first. Such a schedule exists and earliest-deadline-first finds
it, as blocks have unit length and the weights add up to one. At every slot each source is less than
one block away from its weight, as long as it lasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.joins import fits_broadcast
from ..plans.scratch import scratch_path
from .tables import saved

BLOCK_CHARS = 1 << 16
#: Target weights without a table of them: sizes to this power, so that small sources get more than their share.
EXPONENT = 0.7
#: How often a row can be used.
EPOCHS = 4
#: Slots that are dealt in one job, and slots whose picks are gathered before they join the rest.
RANGE = 1 << 16
STRETCH = 1 << 9
_NEVER = (1 << 63) - 1


def _stripe(key: Column) -> Column:
    """Number of the order key's stripe: its first three hexadecimal digits."""
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


def _chars(text: str) -> Column:
    return F.greatest(F.char_length(F.coalesce(F.col(text), F.lit(""))), F.lit(1)).cast("bigint")


def _key(doc_id: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def laid_out(docs: DataFrame, doc_id: str, source: str, text: str, seed: int) -> DataFrame:
    """``(doc, source, chars, key, before)``: each document's place in its source.

    ``before`` is the number of characters of the source before the document. It is added
    up in two steps, within stripes of the random order and over the stripes' sums,
    so that a source with a third of all rows is never in one task.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc"),
        F.col(source).alias("source"),
        _chars(text).alias("chars"),
        _key(doc_id, seed).alias("key"),
    ).withColumn("stripe", _stripe(F.col("key")))
    sized = saved(sized, "sized")
    sums = sized.groupBy("source", "stripe").agg(F.sum("chars").alias("held"))
    earlier = Window.partitionBy("source").orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("of"), F.col("stripe").alias("at"), F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("source", "stripe").orderBy("key", "doc", "chars").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("chars").over(within), F.lit(0)))
    same = placed["source"].eqNullSafe(offsets["of"]) & (placed["stripe"] == offsets["at"])
    return placed.join(offsets, same).select(
        "doc", "source", "chars", "key", (F.col("base") + F.col("inside")).alias("before")
    )


def shares(
    sizes: DataFrame,
    weights: dict | None = None,
    max_share: float | None = None,
    epochs: int | None = None,
    exponent: float = EXPONENT,
) -> DataFrame:
    """``(source, quota)`` from ``(source, chars)``: a row for each source of the mix.

    With ``epochs`` every character is in the mix at least once and at most so often. The target weights are those of
    ``weights`` (source to positive number), all others share what a table without them leaves in proportion to their
    size, as if listed with it; without a table, weights are sizes to the power ``exponent``. The mix is so long that the source with the most
    characters for its weight is used once, and quotas are the target weights of that length: they are met
    to the character where no source needs more than ``epochs``, and the mix more than so many times the data;
    otherwise a quota is as near as the bounds allow.

    Without ``epochs``: without options the weights are the natural shares and every character is in the mix. With
    ``weights`` (source to positive number) sources that have none are left out, and the mix
    ends where the first source would run out. With ``max_share`` a source above that share is held to
    it: all others keep every character, and what is over the quota of a held source is left
    out. Nothing is held where the held sources alone could not make up the rest of the mix.
    """
    everything = Window.partitionBy()
    if epochs is not None:
        weight = F.pow(F.col("chars").cast("double"), F.lit(exponent))
        if weights:
            listed = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
            named = F.try_element_at(listed, "source")
            size = F.col("chars").cast("double")
            known = F.sum(F.when(named.isNotNull(), size)).over(everything)
            unit = F.sum(named).over(everything) / known  # what a character weighs among the listed
            weight = F.coalesce(named, size * F.coalesce(unit, F.lit(1.0)))
        weighed = sizes.withColumn("weight", weight).withColumn("weight", F.col("weight") / F.sum("weight").over(everything))
        room = F.max(F.col("chars") / F.col("weight")).over(everything)
        length = F.least(room, F.sum("chars").over(everything) * F.lit(float(epochs)))
        target = F.round(F.col("weight") * length).cast("bigint")
        return weighed.select("source", F.greatest("chars", F.least(F.col("chars") * epochs, target)).alias("quota"))
    if weights:
        wanted = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
        weighed = sizes.withColumn("weight", F.try_element_at(wanted, "source")).where(F.col("weight") > 0)
        room = F.min(F.col("chars") / F.col("weight")).over(everything)
        return weighed.select("source", F.floor(F.col("weight") * room).cast("bigint").alias("quota"))
    if max_share is None:
        return sizes.select("source", F.col("chars").alias("quota"))
    share = F.col("chars") / F.sum("chars").over(everything)
    held = sizes.withColumn("held", share > max_share)
    rest = F.sum(F.when(~F.col("held"), F.col("chars"))).over(everything)
    number = F.sum(F.col("held").cast("int")).over(everything)
    whole = rest / (1 - number * max_share)  # null where every source is held
    quota = F.when(
        F.col("held") & whole.isNotNull() & (number * max_share < 1), F.least("chars", F.floor(whole * max_share))
    ).otherwise(F.col("chars"))
    return held.select("source", quota.cast("bigint").alias("quota"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _times(n: Column, total: Column) -> Column:
    """An exact product: block number times characters can pass 64 bits."""
    return n.cast("decimal(18,0)") * total.cast("decimal(19,0)")


def _next(number: Column, nth: Column, parts: Column, total: Column, block: int) -> Column:
    """Block ``nth`` (from 0) of a source; one past its last block is never released."""
    release = F.when(nth * block < parts, _div(_times(nth, total), parts)).otherwise(F.lit(_NEVER))
    due = F.when(nth * block < parts, _div(_times(nth + 1, total) + parts - 1, parts)).otherwise(F.lit(_NEVER))
    return F.struct(
        due.alias("due"), number.alias("number"), nth.alias("nth"), release.alias("release"), parts.alias("parts")
    )


def period(parts: DataFrame, block: int = 1) -> DataFrame:
    """``(source, nth, slot, release, due)``: the slot of every block of ``block`` of a source's parts.

    ``parts`` is ``(source, parts)``. A fold over the slots with the next block of each source; it sees a
    row for each source, never the data. ``RANGE`` slots are folded in one job, whose blocks and
    last state are written for the next, so that no row grows with the number of slots.
    """
    spark = parts.sparkSession
    held = parts.where(F.col("parts") > 0).select("source", F.col("parts").cast("bigint").alias("parts"))
    total, number = held.agg(F.coalesce(F.sum("parts"), F.lit(0)), F.count(F.lit(1))).first()
    listed = held.groupBy().agg(F.sort_array(F.collect_list(F.struct("source", "parts"))).alias("sources"))
    zero, all_parts = F.lit(0).cast("bigint"), F.lit(total).cast("bigint")
    state = listed.select(
        "sources", F.transform("sources", lambda s, n: _next(n, zero, s["parts"], all_parts, block)).alias("queue")
    )
    none = F.array().cast("array<struct<number:int,nth:bigint,slot:bigint,release:bigint,due:bigint>>")

    def step(state, slot):
        # The least (due, number) among released blocks.
        best = F.array_min(F.filter(state["queue"], lambda q: (q["release"] <= slot)))
        moved = F.transform(  # over one element, so that ``best`` is worked out once
            F.array(best),
            lambda b: F.when(b.isNull(), state).otherwise(
                F.struct(
                    F.transform(
                        state["queue"],
                        lambda q: F.when(
                            q["number"] == b["number"], _next(q["number"], q["nth"] + 1, q["parts"], all_parts, block)
                        ).otherwise(q),
                    ).alias("queue"),
                    F.concat(
                        state["picked"], F.array(F.struct(b["number"], b["nth"], slot.alias("slot"), b["release"], b["due"]))
                    ).alias("picked"),
                )
            ),
        )
        return moved[0]

    def stretch(state, low, high):
        inner = F.aggregate(
            F.sequence(low, F.least(low + STRETCH, high) - 1),
            F.struct(state["queue"].alias("queue"), none.alias("picked")),
            step,
        )
        return F.transform(
            F.array(inner),
            lambda i: F.struct(i["queue"].alias("queue"), F.concat(state["picked"], i["picked"]).alias("picked")),
        )[0]

    # All blocks are released by slot total / block; what is left then, one for each source at most, follows.
    slots, paths = -(-total // block) + number, []
    for low in range(0, max(slots, 1), RANGE):
        high = F.lit(max(min(low + RANGE, slots), 1)).cast("bigint")
        lows = F.sequence(F.lit(low).cast("bigint"), high - 1, F.lit(STRETCH).cast("bigint"))
        start = F.struct(F.col("queue").alias("queue"), none.alias("picked"))
        folded = state.select("sources", F.aggregate(lows, start, lambda s, at: stretch(s, at, high)).alias("end"))
        paths.append(scratch_path(spark, "slots"))
        folded.select("sources", "end.queue", "end.picked").write.parquet(paths[-1])
        dealt = spark.read.parquet(paths[-1])
        state = dealt.select("sources", "queue")
    rows = spark.read.schema(dealt.schema).parquet(*paths).select("sources", F.inline("picked"))
    return rows.select(F.get("sources", F.col("number"))["source"].alias("source"), "nth", "slot", "release", "due")


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
    max_share: float | None = None,
    seed: int = 7,
    epochs: int | None = None,
    exponent: float = EXPONENT,
) -> DataFrame:
    """``(doc, source, epoch, block, release, due, slot, place, kept)`` for every row of ``docs`` and each of its epochs.

    A document is in the block of its first character; one longer than a block takes
    the slots of the blocks it covers. Kept documents in the order of ``(slot, place)`` are
    the mix; of those that are not kept, ``slot`` and the rest are null. Empty and null texts count as one
    character, a null source is a source, equal rows are ordered anyhow. An empty table
    gives an empty result. With ``epochs`` every row is kept, in so many epochs (from 0) as its source's quota
    needs; without, every row is kept unless ``weights`` or ``max_share`` are given (see :func:`shares`).
    """
    placed = saved(laid_out(docs, doc_id, source, text, seed), "laid-out")
    sizes = placed.groupBy("source").agg(F.sum("chars").alias("chars"))
    parts = saved(shares(sizes, weights, max_share, epochs, exponent), "parts")
    slots = saved(period(parts.withColumnRenamed("quota", "parts"), block_chars), "period")
    known = sizes.join(parts.select(F.col("source").alias("of"), "quota"), sizes["source"].eqNullSafe(F.col("of")), "left")
    known = saved(known.select(F.col("source").alias("of"), F.col("chars").alias("size"), "quota"), "quotas")
    known = F.broadcast(known) if fits_broadcast(known) else known
    kept = F.coalesce(F.col("before") < F.col("quota"), F.lit(False))
    last = F.when(kept, _div(F.col("quota") - 1 - F.col("before"), F.col("size"))).otherwise(F.lit(0).cast("bigint"))
    counted = placed.join(known, placed["source"].eqNullSafe(known["of"]), "left").select(
        "doc", "source", "size", "before", kept.alias("kept"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("epoch")
    )
    counted = counted.withColumn("before", F.col("before") + F.col("epoch") * F.col("size"))
    counted = counted.withColumn("block", F.floor(F.col("before") / block_chars))
    turn = slots.select(F.col("source").alias("of"), "nth", "slot", "release", "due")
    same = counted["source"].eqNullSafe(turn["of"]) & counted["kept"] & (counted["block"] == turn["nth"])
    return counted.join(turn, same, "left").select(
        "doc",
        "source",
        F.col("epoch").cast("int").alias("epoch"),
        F.when(F.col("kept"), F.col("block")).cast("bigint").alias("block"),
        "release",
        "due",
        "slot",
        F.when(F.col("kept"), F.col("before") - F.col("block") * block_chars).cast("bigint").alias("place"),
        "kept",
    )


def mixed(
    docs: DataFrame, weights: dict | None = None, doc_id: str = "doc_id", epochs: int | None = None, **options
) -> DataFrame:
    """``docs`` as often as the mix has them, columns unchanged.

    With ``epochs`` a row comes once for each of its epochs; without, rows over their source's quota are left out and
    rows without an id are kept.
    """
    if epochs is not None:
        return _repeated(docs, weights, doc_id, epochs, **options)
    over = mix(docs, weights, doc_id, **options).where(~F.col("kept")).select(F.col("doc").alias("_over"))
    return docs.join(over, docs[doc_id] == F.col("_over"), "left_anti")


def _repeated(
    docs: DataFrame,
    weights: dict | None,
    doc_id: str,
    epochs: int,
    source: str = "source",
    text: str = "text",
    seed: int = 7,
    exponent: float = EXPONENT,
) -> DataFrame:
    """A source's quota is some whole epochs and the first rows of one more.

    Those rows are told by the last of them in the source's order: a row for each source, so that the texts are
    not shuffled. Rows that are equal in id and size come equally often.
    """
    placed = saved(laid_out(docs, doc_id, source, text, seed), "laid-out")
    sizes = placed.groupBy("source").agg(F.sum("chars").alias("size"))
    parts = shares(sizes.withColumnRenamed("size", "chars"), weights, None, epochs, exponent)
    quotas = sizes.join(parts.select(F.col("source").alias("_of"), "quota"), sizes["source"].eqNullSafe(F.col("_of")))
    quotas = saved(quotas.select("_of", _div(F.col("quota"), F.col("size")).alias("_whole"), (F.col("quota") % F.col("size")).alias("_part")), "quotas")
    small = fits_broadcast(quotas)
    hint = F.broadcast if small else (lambda df: df)
    begun = placed.join(hint(quotas), placed["source"].eqNullSafe(quotas["_of"])).where(F.col("before") < F.col("_part"))
    ends = begun.groupBy("_of").agg(F.max(F.struct("key", "doc", "chars")).alias("_upto"))
    plan = quotas.join(ends.withColumnRenamed("_of", "_end_of"), quotas["_of"].eqNullSafe(F.col("_end_of")), "left")
    plan = saved(plan.select("_of", "_whole", "_upto"), "repeats")
    mine = F.struct(_key(doc_id, seed).alias("key"), F.col(doc_id).alias("doc"), _chars(text).alias("chars"))
    more = F.coalesce(mine <= F.col("_upto"), F.lit(False)).cast("bigint")
    joined = docs.join(hint(plan), docs[source].eqNullSafe(F.col("_of")))
    return joined.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_whole") + more)).alias("_copy")).drop("_copy")


def scheduled(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", block_chars: int = BLOCK_CHARS, seed: int = 7
) -> DataFrame:
    """``docs`` with ``slot`` and ``place``, their order by natural shares: after :func:`mixed` those of the target weights.

    Copies of a row are rows of their own and fall anywhere in their source's order. ``docs`` is read
    twice and must give its rows in the same order, as stored tables do.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    turns = mix(numbered, None, "_row", source, text, block_chars, seed=seed)
    turns = saved(turns.select(F.col("doc").alias("_row"), F.col("slot"), F.col("place")), "turns")
    named = [c for c in docs.columns if c not in ("slot", "place")]
    return numbered.select(*named, "_row").join(F.broadcast(turns) if fits_broadcast(turns) else turns, "_row").drop("_row")
