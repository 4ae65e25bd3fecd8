"""Repeated passages against a search for all windows of words."""

import random

import pytest
from corpusloom.llm import suffixes
from corpusloom.llm.queries import op7_suffix_array_repeats


def plain(rows, size):
    """Maximal runs of words in windows that two documents share, by first and later documents."""
    texts = [(d, (t or "").encode().split()) for d, t in rows if d is not None]
    held = {}
    for doc, words in texts:
        for i in range(len(words) - size + 1):
            held.setdefault(tuple(words[i : i + size]), set()).add(doc)
    out = set()
    for doc, words in texts:
        for later in (False, True):
            marked = []
            for i in range(len(words) - size + 1):
                docs = held[tuple(words[i : i + size])]
                if len(docs) > 1 and (doc > min(docs)) == later:
                    marked.append(i)
            start = stop = None
            for i in marked:
                if start is not None and i > stop:
                    out.add((doc, later, start, stop - start))
                    start = None
                start = i if start is None else start
                stop = i + size
            if start is not None:
                out.add((doc, later, start, stop - start))
    return out


def made(rng, n, words):
    passages = [[f"p{rng.randrange(9)}" for _ in range(rng.randint(5, 30))] for _ in range(4)]
    rows = []
    for doc in range(n):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [f"w{rng.randrange(words)}" for _ in range(rng.randint(0, 20))]
            text += rng.choice(passages)[rng.randint(0, 5) :] if rng.random() < 0.6 else []
        rows.append((doc, " \n".join(text)))
    return rows


@pytest.mark.parametrize("seed,words", [(1, 5), (2, 3), (3, 400)])
def test_against_all_windows(spark, seed, words):
    rows = made(random.Random(seed), 60, words)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {tuple(r) for r in suffixes.repeated_passages(docs, min_words=8, spread=5, group=2).collect()}
    assert found == plain(rows, 8)


def test_crowded_suffixes(spark, monkeypatch):
    rows = made(random.Random(5), 150, 4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(suffixes, "PROBE", 2)
    ordinary = suffixes.shared_ranges
    monkeypatch.setattr(suffixes, "shared_ranges", lambda *args: ordinary(*args, crowd=12))
    found = {tuple(r) for r in suffixes.repeated_passages(docs, min_words=8, spread=5, group=2).collect()}
    assert found == plain(rows, 8)


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 1])
def test_windows_that_agree_in_32_bits(spark, monkeypatch, crowd):
    shared = " ".join(f"w{k}" for k in range(49))
    rows = [(n, f"{shared} {last}") for n, last in enumerate(["x38638", "x305269", "x158862", "x349302", "same", "same"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(suffixes, "PROBE", 1)
    ordinary = suffixes.shared_ranges
    monkeypatch.setattr(suffixes, "shared_ranges", lambda *args: ordinary(*args, crowd=crowd))
    found = {tuple(r) for r in suffixes.repeated_passages(docs).collect()}
    assert found == plain(rows, 50) == {(4, False, 0, 50), (5, True, 0, 50)}


def test_edges(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(1, f"a {passage} b"), (2, f"c {passage}"), (3, None), (4, ""), (None, passage), (5, "x " * 30_000), (6, "short"),
            (7, f"{passage} {passage}".replace("word", "own")), (9, f"Z {passage} Z"), (9, f"Z {passage} Z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 key", "2 doc", "3 first")
    found = {tuple(r) for r in suffixes.repeated_passages(docs).collect()}
    assert found == {(1, False, 1, 60), (2, True, 1, 60), (9, True, 1, 60)}
    assert suffixes.repeated_passages(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffixes.repeated_passages(docs, min_words=20)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in op7_suffix_array_repeats(spark, sf_dir).collect()} == plain(rows, 50)
