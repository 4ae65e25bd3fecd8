"""Decontamination against a word-by-word search; removal of spans and documents."""

import re

import pytest
from corpusloom.llm import decontaminate as dc
from corpusloom.llm.oracles import ORACLES
from corpusloom.llm.queries import op8_benchmark_decontamination


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = set()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in range(1, size + 1):
                if i + n <= len(w) and tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.add((doc, len(w), len(hit), tuple(sorted(found, key=str))))
    return out


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM"), (10, "Été chaud"), (4, None), (5, "--"), (None, "one two three four five six seven eight nine ten")]
DOCS = [
    (1, "x ONE two-three four, five six seven eight nine TEN eleven twelve y"), (2, "a short item; short\nitem"),
    (3, None), (4, ""), (5, "été CHAUD"), (6, "Été Chaud \U0001f600"), (7, "one two three four five six seven eight nine"),
    (None, "short item"), (8, "clean"), (8, "clean"), (9, "short item " * 4000 + "end."),
]


@pytest.fixture
def frames(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "1 key", "2 pos", "3 window")
    return docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")


def found(docs, items):
    rows = dc.find_hits(docs, items).collect()
    return {(r.doc, r.n_words, r.n_hit, tuple(sorted(r["items"], key=str))) for r in rows}


def test_small_texts(frames):
    docs, items = frames
    expected = {(d, n, h, tuple(i for i in f if i is not None)) for d, n, h, f in plain(DOCS, ITEMS)}
    assert found(docs, items) == expected


def test_shuffle_join_gives_the_same(frames, monkeypatch):
    docs, items = frames
    broadcast = found(docs, items)
    monkeypatch.setattr(dc, "fits_broadcast", lambda df: False)
    assert found(docs, items) == broadcast


def test_removal(frames):
    docs, items = frames
    kept = dc.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7, 8, 8]
    cut = {r.doc_id: r.text for r in dc.remove_spans(docs, items).collect()}
    assert cut[1] == "x y" and cut[2] == "a" and cut[9] == " end." and cut[8] == "clean" and cut[None] == ""


def test_empty_tables(frames):
    docs, items = frames
    assert dc.find_hits(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in dc.find_hits(docs, items.limit(0)).collect()} == {0}


def test_query_against_sql(spark, sf_dir, same_as_sql):
    same_as_sql(op8_benchmark_decontamination(spark, sf_dir), ORACLES["op8_benchmark_decontamination"])


def test_no_python_in_the_plan(frames):
    plan = dc.find_hits(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow", plan)
