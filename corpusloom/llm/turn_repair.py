"""Cheapest repairs of damaged conversations, by one integer weight for cost and audit.

A row is kept, given another role or deleted, and turns with empty text can be inserted, so that
the initials of the roles read ``(s?(ua)+)?``. The nodes of the graph are (rows
read, role read last); an edge reads one row, with at most one insertion before it: a
cheapest repair never inserts two turns side by side, as the two could be left out.

An edge weighs ``cost << 6 n`` plus two octal digits at the row's own place among n rows: the letters of its
edits, D 1, I 2, K 3, R 4 as their ASCII order is, with a zero behind a single letter. Letters of
two paths that first differ, differ within one row's two digits, so the smallest integer has the
least cost and, among those, the audit that is least in ASCII order. A plain shortest path
in integers decides everything; the edits are read off its low digits.

Conversations of any length are cut into segments of at most ``SEGMENT`` rows. A segment gives the best
weight for each pair of first and last node, and ranks their audits; the segments of a conversation
are then the rows of a second graph, whose low digits are those ranks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.joins import fits_broadcast, join_on_small
from ..session import ship_package
from .tables import saved

SEGMENT_BITS = 10
SEGMENT = 1 << SEGMENT_BITS
RANK_BITS = 5

#: What has been read last: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = " DIKR"
RETYPE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1

#: Kinds of rows: initial of the role (o: any other), as it is, cut short, or to be deleted.
INITIALS = "suao"
FINE, SHORT, GONE = "suao", "SUAO", "1234"


def _edits(kind: str, state: int) -> Iterator[tuple[int, int, str]]:
    """``(state after, cost, letter)`` of each edit of a row of ``kind``."""
    yield state, DELETE, "D"
    if kind in GONE:
        return
    extra = CUT_SHORT if kind in SHORT else 0
    kept = NEXT.get(kind.lower(), {}).get(state)
    if kept is not None:
        yield kept, extra, "K"
    for role in "ua":
        if state in NEXT[role]:
            yield NEXT[role][state], RETYPE + extra, "R"


@lru_cache(maxsize=None)
def _edges(kind: str, state: int) -> tuple[tuple[int, int, int], ...]:
    """``(state after, cost, two digits)`` of all ways to read one row."""
    found = [(after, cost, DIGIT[letter] * 8) for after, cost, letter in _edits(kind, state)]
    for role in "ua":
        if state in NEXT[role]:
            inserted = _edits(kind, NEXT[role][state])
            found += [(after, cost + INSERT, DIGIT["I"] * 8 + DIGIT[letter]) for after, cost, letter in inserted]
    return tuple(found)


def _shortest(kinds: str, start: int) -> dict[int, int]:
    """The least weight from ``start`` to each last state."""
    n = len(kinds)
    best = {start: 0}
    for i, kind in enumerate(kinds):
        shift, whole = 6 * (n - 1 - i), 6 * n
        reached: dict[int, int] = {}
        for state, weight in best.items():
            for after, cost, digits in _edges(kind, state):
                total = weight + (cost << whole) + (digits << shift)
                if after not in reached or total < reached[after]:
                    reached[after] = total
        best = reached
    return best


def _slots(kinds: str, start: int, audit: int) -> str:
    """Two characters a row: role of the inserted turn or a space; K, D, or U or A for a new role."""
    state, slots = start, []
    for i, kind in enumerate(kinds):
        digits = (audit >> 6 * (len(kinds) - 1 - i)) & 63
        letters = (LETTER[digits >> 3] + LETTER[digits & 7]).strip()
        inserted = " "
        if letters[0] == "I":
            inserted = "a" if state == USER else "u"
            state = NEXT[inserted][state]
        edit = letters[-1]
        if edit == "K":
            state = NEXT[kind.lower()][state]
        elif edit == "R":
            edit = "A" if state == USER else "U"
            state = NEXT[edit.lower()][state]
        slots.append(inserted + edit)
    return "".join(slots)


@lru_cache(maxsize=1 << 14)
def ways(kinds: str) -> tuple[tuple[int, int, int, int, str], ...]:
    """``(first state, last state, cost, rank of the audit, slots)`` of the best paths through some rows."""
    whole = 6 * len(kinds)
    cells = [
        (start, end, weight >> whole, weight & ((1 << whole) - 1))
        for start in range(4)
        for end, weight in _shortest(kinds, start).items()
    ]
    rank = {audit: at for at, audit in enumerate(sorted({cell[3] for cell in cells}))}
    return tuple((s, e, cost, rank[audit], _slots(kinds, s, audit)) for s, e, cost, audit in cells)


def choose(segments: list[list[tuple[int, int, int, int]]]) -> tuple[int, list[tuple[int, int]], bool]:
    """Cost, first and last state of each segment, and whether an assistant turn is inserted at the end.

    ``segments`` have ``(first, last, cost, rank)`` each; the lowest digits are of the end.
    """
    n = len(segments)
    whole = RANK_BITS * n + 2
    best = {START: 0}
    for i, cells in enumerate(segments):
        shift = RANK_BITS * (n - 1 - i) + 2
        reached: dict[int, int] = {}
        for first, last, cost, rank in cells:
            if first in best:
                total = best[first] + (cost << whole) + (rank << shift)
                if last not in reached or total < reached[last]:
                    reached[last] = total
        best = reached
    ends = [best[state] for state in (START, ASSISTANT) if state in best]
    if USER in best:
        ends.append(best[USER] + (INSERT << whole) + DIGIT["I"])
    weight = min(ends)
    state, path = START, []
    for i, cells in enumerate(segments):
        rank = (weight >> (RANK_BITS * (n - 1 - i) + 2)) & ((1 << RANK_BITS) - 1)
        last = next(cell[1] for cell in cells if cell[0] == state and cell[3] == rank)
        path.append((state, last))
        state = last
    return weight >> whole, path, bool(weight & 3)


def _with_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cell = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("slots", pa.string())])
    names = ("first", "last", "cost", "rank", "slots")
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            some = batch.slice(low, 256)
            kinds = some["kinds"].to_pylist()
            initials = [k.translate(_INITIAL_OF) for k in kinds]
            found = [[dict(zip(names, way)) for way in ways(k)] for k in kinds]
            yield pa.record_batch(
                {
                    "conv": some["conv"],
                    "segment": some["segment"],
                    "begins": some["begins"],
                    "head": pa.array([i[0] for i in initials], pa.string()),
                    "tail": pa.array([i[-1] for i in initials], pa.string()),
                    "illegal": pa.array([sum(map(_illegal, i, i[1:])) for i in initials], pa.int64()),
                    "ways": pa.array(found, pa.list_(cell)),
                }
            )


_INITIAL_OF = str.maketrans(FINE + SHORT + GONE, INITIALS * 3)


def _illegal(left: str, right: str) -> bool:
    return left + right not in ("su", "ua", "au")


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pick = pa.struct([("segment", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            some = batch.slice(low, 256)
            costs, picks, closing, illegal = [], [], [], []
            for segments in some["segments"].to_pylist():
                cells = [[(c["first"], c["last"], c["cost"], c["rank"]) for c in s["cells"]] for s in segments]
                cost, path, closed = choose(cells)
                costs.append(cost)
                closing.append(closed)
                picks.append(
                    [{"segment": s["segment"], "first": a, "last": b} for s, (a, b) in zip(segments, path)]
                )
                seams = sum(_illegal(s["tail"], t["head"]) for s, t in zip(segments, segments[1:]))
                illegal.append(seams + sum(s["illegal"] for s in segments))
            yield pa.record_batch(
                {
                    "conv": some["conv"],
                    "cost": pa.array(costs, pa.int64()),
                    "illegal": pa.array(illegal, pa.int64()),
                    "closing": pa.array(closing, pa.bool_()),
                    "picks": pa.array(picks, pa.list_(pick)),
                }
            )


def _kind(fault: Column, initial: Column) -> Column:
    at = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    return (
        F.when(fault.isin("blank", "duplicate"), F.substr(F.lit(GONE), at, F.lit(1)))
        .when(fault == "truncated", F.substr(F.lit(SHORT), at, F.lit(1)))
        .otherwise(F.substr(F.lit(FINE), at, F.lit(1)))
    )


class Repairs:
    """Results of :func:`repair`: DataFrames over tables that are written once.

    ``report``: a row for each conversation with ``conv_id, n_rows, gaps, blank, duplicate, truncated, illegal,
    cost, audit``. ``turns``: the repaired turns as ``conv_id, place, part, edit, role, text``, ordered
    within a conversation by place and part.
    """

    def __init__(self, report: DataFrame, turns: DataFrame):
        self.report, self.turns = report, turns


def repair(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repairs:
    """The cheapest repair of every conversation; see the module for edits and costs.

    Rows are taken by turn, nulls first, then by role and text. A null role or text counts as one space; rows
    without an id form one conversation. A text of white space (``[\\x20\\x09-\\x0D]``) only is blank, a role and text
    seen earlier in the conversation a duplicate, a text that doesn't end in ``.``, ``!`` or ``?`` (white space
    aside) truncated; the first of these counts. ``gaps`` are the whole numbers missing
    between the least and greatest turn. Repeated rows are duplicates; an empty table gives empty
    results, other columns are not looked at.

    Rows are range partitioned by conversation and order, so that a conversation of any length is
    spread over tasks, in segments of at most :data:`SEGMENT` rows. One row for each segment meets in the choice of a
    conversation's path, and the audit is one string of a letter or two for each row: both
    must fit a row of 2 GB.
    """
    spark = turns.sparkSession
    ship_package(spark)
    said = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    ordered = said.repartitionByRange("conv_id", "turn", "role", F.substr("text", F.lit(1), F.lit(64)))
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text")
    end = F.right(F.expr(r"rtrim(' \u0009\u000A\u000B\u000C\u000D', text)"), F.lit(1))
    rows = saved(
        ordered.select(
            "conv_id",
            F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv"),
            F.monotonically_increasing_id().alias("place"),
            "turn",
            "role",
            "text",
            F.sha2("text", 256).alias("sha"),
            (end == "").alias("blank"),
            (~end.isin(".", "!", "?")).alias("short"),
        ),
        "turns",
    )
    slim = rows.select(
        "conv_id", "conv", "place", F.shiftright("place", SEGMENT_BITS).alias("segment"), "turn", "role", "sha", "blank", "short"
    )
    first = (
        slim.where(~F.col("blank"))
        .groupBy("conv", "role", "sha")
        .agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    again = (
        join_on_small(slim.where(~F.col("blank")).select("conv", "role", "sha", "place"), first, ["conv", "role", "sha"], salt_by=["place"])
        .where(F.col("place") > F.col("earliest"))
        .select("place", F.lit(True).alias("again"))
    )
    again = saved(again, "repeated-turns")
    marked = slim.join(F.broadcast(again) if fits_broadcast(again) else again, "place", "left")
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("again"), "duplicate")
        .when(F.col("short"), "truncated")
    )
    marked = saved(
        marked.select(
            "conv_id", "conv", "place", "segment", "turn", fault.alias("fault"),
            _kind(fault, F.substring("role", 1, 1)).alias("kind"),
        ),
        "faults",
    )

    def count_of(name: str) -> Column:
        return F.count_if(F.col("fault") == name).alias(name)

    turns_of = marked.groupBy("conv", "turn").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), *[count_of(f) for f in ("blank", "duplicate", "truncated")]
    )
    width = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count("turn")
    counts = turns_of.groupBy("conv").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n_rows"),
        F.coalesce(F.least(width, F.lit((1 << 63) - 1)).cast("bigint"), F.lit(0).cast("bigint")).alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )

    listed = F.array_sort(F.collect_list(F.struct("place", "kind")))
    segments = marked.groupBy("conv", "segment").agg(
        F.min("place").alias("begins"), F.array_join(F.transform(listed, lambda r: r["kind"]), "").alias("kinds")
    )
    segments = saved(
        segments.select("conv", "segment", "begins", "kinds").mapInArrow(
            _with_ways,
            "conv string, segment bigint, begins bigint, head string, tail string, illegal bigint, "
            "ways array<struct<first: int, last: int, cost: bigint, rank: int, slots: string>>",
        ),
        "segments",
    )
    cells = F.transform("ways", lambda w: F.struct(w["first"].alias("first"), w["last"].alias("last"), w["cost"].alias("cost"), w["rank"].alias("rank")))
    chosen = saved(
        segments.groupBy("conv")
        .agg(F.array_sort(F.collect_list(F.struct("segment", "head", "tail", "illegal", cells.alias("cells")))).alias("segments"))
        .mapInArrow(
            _chosen,
            "conv string, cost bigint, illegal bigint, closing boolean, "
            "picks array<struct<segment: bigint, first: int, last: int>>",
        ),
        "choices",
    )
    last = F.posexplode("picks").alias("at", "pick")
    picked = chosen.select("conv", "closing", F.size("picks").alias("n"), last).select(
        "conv",
        F.col("pick.segment").alias("segment"),
        F.col("pick.first").alias("from_state"),
        F.col("pick.last").alias("to_state"),
        (F.col("closing") & (F.col("at") == F.col("n") - 1)).alias("closing"),
    )
    slots = F.filter("ways", lambda w: (w["first"] == F.col("from_state")) & (w["last"] == F.col("to_state")))[0]["slots"]
    decided = saved(
        segments.join(picked, ["conv", "segment"]).select("conv", "segment", "begins", slots.alias("slots"), "closing"),
        "repairs",
    )
    letters = F.concat(F.translate("slots", "uaUA ", "IIRR"), F.when(F.col("closing"), "I").otherwise(""))
    pieces = F.array_sort(F.collect_list(F.struct("segment", letters.alias("letters"))))
    audits = decided.groupBy("conv").agg(F.array_join(F.transform(pieces, lambda p: p["letters"]), "").alias("audit"))
    report = (
        counts.join(chosen.select("conv", "illegal", "cost"), "conv")
        .join(audits, "conv")
        .select("conv_id", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )
    return Repairs(report, _repaired(rows, decided))


def digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of repaired turns, as lines ``role:text`` joined by line feeds.

    Conversations without turns have no row. Lines stream through a task in order, so memory
    doesn't grow with a conversation; a hash of all of it is made in one task by its nature.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv_id, digest = None, None, None
        for batch in batches:
            out: tuple[list, list] = [], []
            for conv, name, line in zip(*(batch[c].to_pylist() for c in ("conv", "conv_id", "line"))):
                if conv == held:
                    digest.update(b"\n")
                else:
                    if held is not None:
                        out[0].append(conv_id)
                        out[1].append(digest.hexdigest())
                    held, conv_id, digest = conv, name, hashlib.sha256()
                digest.update(line.encode())
            yield pa.record_batch({"conv_id": pa.array(out[0], batch["conv_id"].type), "repaired_sha256": pa.array(out[1], pa.string())})
        if held is not None:
            yield pa.record_batch({"conv_id": pa.array([conv_id], batch["conv_id"].type), "repaired_sha256": pa.array([digest.hexdigest()])})

    lines = turns.select("conv", "conv_id", "place", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "place", "part")
    kind = turns.schema["conv_id"].dataType.simpleString()
    return lines.select("conv", "conv_id", "line").mapInArrow(hashed, f"conv_id {kind}, repaired_sha256 string")


def _repaired(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """The turns that are kept, changed or inserted."""
    at = (F.col("place") - F.col("begins")).cast("int")
    joined = (
        rows.select("conv_id", "conv", "place", F.shiftright("place", SEGMENT_BITS).alias("segment"), "role", "text")
        .join(decided, ["conv", "segment"])
        .withColumn("before", F.substr("slots", 2 * at + 1, F.lit(1)))
        .withColumn("edit", F.substr("slots", 2 * at + 2, F.lit(1)))
        .withColumn("final", F.col("closing") & (2 * at + 2 == F.length("slots")))
    )

    def turn(part: int, holds: Column, edit: Column, role: Column, text: Column) -> Column:
        made = F.struct(F.lit(part).alias("part"), edit.alias("edit"), role.alias("role"), text.alias("text"))
        return F.when(holds, made)

    edit = F.col("edit")
    parts = F.array(
        turn(0, F.col("before") != " ", F.lit("I"), F.when(F.col("before") == "u", "user").otherwise("assistant"), F.lit("")),
        turn(
            1,
            edit != "D",
            F.when(edit == "K", "K").otherwise("R"),
            F.when(edit == "U", "user").when(edit == "A", "assistant").otherwise(F.col("role")),
            F.col("text"),
        ),
        turn(2, F.col("final"), F.lit("I"), F.lit("assistant"), F.lit("")),
    )
    return joined.select("conv_id", "conv", "place", F.inline(F.array_compact(parts)))
