"""Corpus folders: names Spark would pass over, encodings, numbering by name."""

import pytest

from corpusloom.operators import frequency as fq
from corpusloom.plans import scratch
from corpusloom.plans.ranking import dense_numbers
from corpusloom.sources import corpus


def test_hidden_names_are_refused(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one")
    (tmp_path / "_SUCCESS").write_bytes(b"")
    assert corpus.read_corpus(spark, str(tmp_path)).count() == 1
    (tmp_path / "_b.txt").write_bytes(b"two")
    assert corpus.read_corpus(spark, str(tmp_path), ".md").count() == 0
    with pytest.raises(ValueError, match="_b.txt"):
        corpus.read_corpus(spark, str(tmp_path), ".txt")


def test_lines_in_latin_1(spark, tmp_path):
    (tmp_path / "a").write_bytes("café\nÜber ß".encode("latin-1"))
    lines = corpus.read_corpus_lines(spark, str(tmp_path), "ISO-8859-1").collect()
    assert [r.text for r in lines] == ["café", "Über ß"]


def test_first_occurrences_in_the_order_of_names(spark, tmp_path):
    for name, text in {"b.txt": "x y", "a.txt": "y", "c.md": "z"}.items():
        (tmp_path / name).write_text(text)
    docs = corpus.numbered_files(corpus.read_corpus(spark, str(tmp_path), ".txt"))
    counts = fq.counts_from_ngrams(fq.ngrams(docs, 1))
    assert [(r.ngram, r.n) for r in fq.rank_by_count(counts).collect()] == [("y", 2), ("x", 1)]
    assert "SortAggregate" not in counts._jdf.queryExecution().executedPlan().toString()


def test_dense_numbers(spark):
    values = spark.createDataFrame([(f"v{k:03d}",) for k in (5, 3, 3, 900, 41)] , "name string")
    found = {r["name"]: r["number"] for r in dense_numbers(values, "name").collect()}
    assert found == {"v003": 0, "v005": 1, "v041": 2, "v900": 3}


def test_scratch_tables_share_a_folder_of_the_run(spark):
    import os

    paths = [scratch.scratch_path(spark, "some") for _ in range(2)]
    assert paths[0] != paths[1] and paths[0].startswith(scratch.run_folder(spark) + "/")
    for path in paths:
        spark.range(3).write.parquet(path)
    held = os.listdir(scratch.run_folder(spark))
    assert len(held) >= 2


def test_hidden_names_are_found_without_a_call_for_each_file(spark, tmp_path, monkeypatch):
    for k in range(400):
        (tmp_path / f"f{k}.txt").write_bytes(b"one")
    calls, send = [], spark._jvm._gateway_client.send_command
    monkeypatch.setattr(spark._jvm._gateway_client, "send_command", lambda *a, **k: calls.append(1) or send(*a, **k))
    assert corpus.hidden_files(spark, str(tmp_path)) == []
    assert len(calls) < 100


def test_files_of_a_folder_are_not_listed_on_the_driver(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"p %20+{k}.txt").write_bytes(b"caf\xe9\r\n" * (k % 3))
    (tmp_path / "notes.md").write_bytes(b"no text")
    (tmp_path / "sub.txt").mkdir()
    docs = corpus.read_corpus(spark, str(tmp_path), ".txt")
    assert len(docs.inputFiles()) < 10
    expected = {f"p %20+{k}.txt": "café\n" * (k % 3) for k in range(300) if k % 3}  # Spark's readers pass over empty files
    assert dict(docs.collect()) == expected
    names = corpus.file_names(spark, str(tmp_path), ".txt")
    assert {r.doc_id for r in names.collect()} == set(expected)
    numbered = corpus.numbered_files(docs, names).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in numbered] == [(n, expected[name]) for n, name in enumerate(sorted(expected))]


def test_a_file_is_read_by_its_path(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one")
    (tmp_path / "b.txt").write_bytes(b"two")
    assert [tuple(r) for r in corpus.read_corpus(spark, str(tmp_path / "a.txt")).collect()] == [("a.txt", "one")]
    assert [tuple(r) for r in corpus.read_corpus(spark, f"{tmp_path}/b*").collect()] == [("b.txt", "two")]
