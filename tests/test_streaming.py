from corpusloom.operators.fields import fields_of_columns, open_index, write_index
from corpusloom.operators.frequency import ngram_counts
from corpusloom.operators.search import match_all, term_search
from corpusloom.sources.corpus import read_corpus
from corpusloom.streaming import incremental as inc


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.txt").write_bytes(text.encode("latin-1"))


def test_running_counts_equal_batch_counts(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, a="the cat the", b="the café", c="a cat")
    docs = inc.corpus_stream(spark, str(folder), ".txt", max_files=1)
    query = (
        ngram_counts(docs, 1)
        .writeStream.outputMode("complete").format("memory").queryName("running")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    running = sorted(map(tuple, spark.table("running").collect()))
    batch = ngram_counts(read_corpus(spark, str(folder), ".txt"), 1)
    assert running == sorted(map(tuple, batch.collect()))


def test_index_grows_by_batches(spark, tmp_path):
    folder, index = tmp_path / "in", str(tmp_path / "index")

    def run():
        docs = inc.corpus_stream(spark, str(folder), ".txt", max_files=1)
        inc.index_stream(docs, index).option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start().awaitTermination(120)

    write(folder, a="red gear", b="blue gear")
    run()
    write(folder, c="green gear")
    run()
    run()
    opened = open_index(spark, index)
    assert {r.doc_id for r in term_search(opened, "text", "gear").collect()} == {
        "a.txt", "b.txt", "c.txt",
    }
    assert match_all(opened).count() == 3


def test_streams_add_to_an_index_and_to_each_other(spark, tmp_path):
    index = str(tmp_path / "index")
    first = spark.createDataFrame([("old", "gear")], "doc_id string, text string")
    write_index(fields_of_columns(first, "doc_id", text="text"), index)
    for name in ("one", "two"):
        write(tmp_path / name, **{name: "gear"})
        docs = inc.corpus_stream(spark, str(tmp_path / name), ".txt")
        inc.index_stream(docs, index).option(
            "checkpointLocation", str(tmp_path / f"cp-{name}")
        ).trigger(availableNow=True).start().awaitTermination(120)
    found = term_search(open_index(spark, index), "text", "gear").collect()
    assert sorted(r.doc_id for r in found) == ["old", "one.txt", "two.txt"]


def test_running_counts_hand_on_only_what_changes(spark, tmp_path):
    from collections import Counter

    from corpusloom.operators.frequency import counts_from_ngrams, ngrams, rank_by_count
    from corpusloom.streaming import running as ru

    folder, path = tmp_path / "in", str(tmp_path / "counts")

    def run():
        docs = inc.corpus_stream(spark, str(folder), ".txt", max_files=1)
        ru.running_counts(docs, 1, path).option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True
        ).start().awaitTermination(180)

    many = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400))
    write(folder, b="tie " + many)
    run()
    write(folder, a="tie other", c="other new new")
    run()
    write(folder, d="tie")
    run()
    changes = [spark.read.parquet(f"{path}/changes/batch={n}").count() for n in range(4)]
    assert changes[0] == 401 and sorted(changes[1:]) == [1, 2, 2]
    found = rank_by_count(ru.open_counts(spark, path)).collect()
    batch = rank_by_count(counts_from_ngrams(ngrams(read_corpus(spark, str(folder), ".txt"), 1))).collect()
    assert [(r.ngram, r.n, r.first) for r in found] == [(r.ngram, r.n, r.first) for r in batch]
    assert Counter({r.ngram: r.n for r in found})["tie"] == 3
    assert [r.ngram for r in found[:3]] == ["tie", "other", "new"]
    assert len(ru._numbers(spark, f"{path}/base", "upto")) == 1


def test_running_counts_hold_no_state_and_add_a_batch_once(spark, tmp_path):
    from corpusloom.streaming import running as ru

    folder, path, kept = tmp_path / "in", str(tmp_path / "counts"), tmp_path / "cp"

    def run():
        docs = inc.corpus_stream(spark, str(folder), ".txt", max_files=1)
        ru.running_counts(docs, 2, path).option("checkpointLocation", str(kept)).trigger(availableNow=True).start().awaitTermination(180)
        return sorted((r.ngram, r.n) for r in ru.open_counts(spark, path).collect())

    write(folder, a="one two one two", b="two one")
    once = run()
    assert once == [("one two", 2), ("two one", 2)]
    assert not list(kept.rglob("*.delta")) and not list(kept.rglob("*.snapshot"))
    last = max(int(f.name) for f in (kept / "commits").iterdir() if f.name.isdigit())
    (kept / "commits" / str(last)).unlink()  # the last micro-batch is delivered again
    (kept / "commits" / f".{last}.crc").unlink(missing_ok=True)
    assert run() == once


def test_streamed_corpus_has_more_files_and_not_larger_ones(spark, tmp_path, monkeypatch):
    from corpusloom import queries as q

    spark.range(1300).coalesce(1).selectExpr("id AS doc_id", "'red gear' AS text").write.parquet(str(tmp_path / "documents.parquet"))
    seen = {}

    def stream(spark, path, *args, max_files, **options):
        seen.update(path=path, max_files=max_files)
        return inc.corpus_stream(spark, path, *args, max_files=max_files, **options)

    monkeypatch.setattr(q, "corpus_stream", stream)
    found = {r.ngram: r.n for r in q.all_queries()["streamed_unigrams"](spark, str(tmp_path)).collect()}
    assert found == {"red": 1300, "gear": 1300}
    per_file = [r.n for r in read_corpus(spark, seen["path"], ".txt").selectExpr("size(split(text, 'red')) - 1 AS n").collect()]
    assert max(per_file) <= q.PER_FILE and -(-len(per_file) // seen["max_files"]) <= 3
