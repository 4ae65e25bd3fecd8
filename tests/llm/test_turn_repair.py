"""Repairs against an exhaustive search, segments against whole conversations, edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from corpusloom.llm import turn_repair as tr
from corpusloom.llm.queries import damaged, op12_turn_repair

LEGAL = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        if not text.strip(WHITE):
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif text.rstrip(WHITE)[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append(None)
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, audit, lines) by a search over whole audits, kept for each place and state of the pattern."""
    marks = faults(rows)

    def step(state, letter):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, letter))

    @lru_cache(maxsize=None)
    def rest(i, state, inserted):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text = rows[i]
            cost, audit, lines = rest(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, lines))
            if marks[i] not in ("blank", "duplicate"):
                extra = int(marks[i] == "truncated")
                for edit, new, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    after = step(state, new[:1])
                    if after:
                        cost, audit, lines = rest(i + 1, after, 0)
                        options.append((cost + price + extra, edit + audit, (f"{new}:{text}", *lines)))
        if inserted < 3:
            for new in ("user", "assistant"):
                after = step(state, new[0])
                if after:
                    cost, audit, lines = rest(i, after, inserted + 1)
                    options.append((cost + 2, "I" + audit, (f"{new}:", *lines)))
        return min(options, default=(10**6, "", ()))

    return rest(0, "", 0)


def plain(rows):
    """What the query returns for the damaged rows ``(turn, role, text)`` of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {r[0] for r in rows if r[0] is not None}
    marks = faults([r[1:] for r in rows])
    cost, audit, lines = cheapest(tuple(r[1:] for r in rows))
    initials = [r[1][:1] for r in rows]
    assert LEGAL.fullmatch("".join(line[0] for line in lines))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain_query(rows):
    held = {r[0]: [] for r in rows}
    for conv, *row in plain_damage(rows):
        held[conv].append(tuple(row))
    return {(conv, *plain(rows)) for conv, rows in held.items()}


def test_query_against_search(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert set(map(tuple, op12_turn_repair(spark, sf_dir).collect())) == plain_query(rows)


def small_table(seed, size):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "agent", "user", "assistant"]
    texts = ["a.", "b!", "c", " \t", "", None, "d? \r\n", "e.\xa0", "a."]
    return [
        (pick.choice([None, 1, 2, 3, 4, 5, 6]), pick.choice([None, 0, 1, 2, 3, 7, 9, -4]), pick.choice(roles), pick.choice(texts))
        for _ in range(size)
    ]


@pytest.mark.parametrize("segment_bits", [1, 10])
def test_edge_cases(spark, tmp_path, monkeypatch, segment_bits):
    monkeypatch.setattr(tr, "SEGMENT_BITS", segment_bits)
    rows = small_table(segment_bits, 150) + [(90, -(1 << 63), "user", "x."), (90, 5, "user", "x.")]
    rows += [(91, 0, "user", "y" * 300_000), (92, None, "assistant", "z"), (93, 4, " ", " ")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.selectExpr("*", "1 place", "2 conv", "3 segment", "4 edit", "5 of")
    (tmp_path / "data").mkdir()
    frame.write.parquet(str(tmp_path / "data/conversations.parquet"))
    found = set(map(tuple, op12_turn_repair(spark, str(tmp_path / "data")).collect()))
    assert found == {(r[0], min(r[1], (1 << 63) - 1), *r[2:]) for r in plain_query(rows)}
    empty = tr.repair(frame.limit(0))
    assert empty.report.count() == 0 and empty.turns.count() == 0 and tr.digests(empty.turns).count() == 0


def test_segments_do_not_matter():
    pick = random.Random(3)
    for _ in range(300):
        kinds = "".join(pick.choices(tr.FINE + tr.SHORT + tr.GONE, k=pick.randint(1, 40)))
        whole = tr.choose([[w[:4] for w in tr.ways(kinds)]])
        cuts = sorted(pick.sample(range(1, len(kinds)), min(len(kinds) - 1, 5)))
        pieces = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)])]
        cost, path, closing = tr.choose([[w[:4] for w in tr.ways(p)] for p in pieces])
        joined = "".join(next(w[4] for w in tr.ways(p) if w[:2] == ends) for p, ends in zip(pieces, path))
        alone = next(w[4] for w in tr.ways(kinds) if w[:2] == whole[1][0])
        assert (cost, closing, joined) == (whole[0], whole[2], alone)


def test_all_short_conversations():
    words = ["s", "u", "a", "o", "U", "2", "S"]
    names = {"s": "sys", "u": "user", "a": "assistant", "o": "tool"}
    for n in range(1, 5):
        for kinds in itertools.product(words, repeat=n):
            rows = tuple(
                (names[tr.INITIALS[(tr.FINE + tr.SHORT + tr.GONE).index(k) % 4]], "" if k == "2" else f"{i}{'' if k in 'US' else '.'}")
                for i, k in enumerate(kinds)
            )
            cost, path, closing = tr.choose([[w[:4] for w in tr.ways("".join(kinds))]])
            slots = next(w[4] for w in tr.ways("".join(kinds)) if w[:2] == path[0])
            audit = slots.translate(str.maketrans({"u": "I", "a": "I", "U": "R", "A": "R", " ": None})) + "I" * closing
            assert (cost, audit) == cheapest(rows)[:2], kinds


def test_damage(spark):
    rows = small_table(8, 200)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = sorted(map(repr, (tuple(r)[:4] for r in damaged(frame).collect())))
    assert found == sorted(map(repr, plain_damage(rows)))
