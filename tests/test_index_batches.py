"""Commits, merges and deletions of a stored index; best hits by blocks."""

import re
import threading

import pytest
from conftest import plan_of
from corpusloom.operators import best as be
from corpusloom.operators import fields as fl
from corpusloom.operators import query_texts as qt
from corpusloom.operators import search as se
from corpusloom.operators.clustered import cluster_postings
from corpusloom.plans.ranking import top_k_per_query
from pyspark.sql import functions as F


def fields_of(spark, rows):
    return fl.fields_of_columns(spark.createDataFrame(rows, "doc_id string, text string"), "doc_id", text="text")


def texts(n, start=0):
    return [(f"d{k}", f"common w{k % 7} w{k % 3} only{k}") for k in range(start, start + n)]


def everything(index):
    hits = {(r.doc_id, round(r.score, 9)) for r in se.any_words(index, "text", "common w1 w2 only3").collect()}
    words = {tuple(r) for r in index.vocabulary.collect()}
    stats = {(r.field, r.n_docs, round(r.avg_len or 0, 9)) for r in fl.field_stats(index).collect()}
    return hits, words, stats, {r.doc_id for r in index.docs.collect()}


def batches(spark, path):
    return fl._Log(spark, path).state().batches


def test_merges_and_deletions_change_no_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fl, "FREQUENT", 5)
    path = str(tmp_path / "index")
    for n in range(5):
        fl.write_index(fields_of(spark, texts(8, 8 * n)), path, "create" if n == 0 else "append")
    gone = spark.createDataFrame([("d3",), ("d9",), ("d9",), (None,), ("nobody",)], "doc_id string")
    fl.delete_documents(spark, path, gone)
    kept = [t for t in texts(40) if t[0] not in ("d3", "d9")]
    alone = everything(fl.write_index(fields_of(spark, kept), str(tmp_path / "alone")))
    assert everything(fl.open_index(spark, path)) == alone
    assert everything(fl.delete_documents(spark, path, gone)) == alone
    assert everything(fl.merge_batches(spark, path, width=4)) == alone
    assert len(batches(spark, path)) == 1
    fl.write_index(fields_of(spark, texts(3, 40)), path, "append")
    fl.delete_documents(spark, path, spark.createDataFrame([("d0",), ("d41",)], "doc_id string"))
    kept = [t for t in texts(43) if t[0] not in ("d0", "d3", "d9", "d41")]
    alone = everything(fl.write_index(fields_of(spark, kept), str(tmp_path / "again")))
    assert everything(fl.open_index(spark, path)) == alone
    whole = fl.merge_batches(spark, path, everything=True)
    assert everything(whole) == alone and fl._Log(spark, path).state().deletions == ()
    assert "only3" not in {r.term for r in whole.postings.select("term").distinct().collect()}
    assert fl.merge_batches(spark, path, everything=True).postings.count() == whole.postings.count()


def test_equal_ids_stay_apart_in_a_merge(spark, tmp_path):
    path = str(tmp_path / "index")
    for text in ("red gear", "red bolt", "gear"):
        mode = "append" if fl.index_exists(spark, path) else "create"
        fl.write_index(fields_of(spark, [("x", text)]), path, mode)
    index = fl.merge_batches(spark, path, width=2)
    assert sorted(r.doc_id for r in se.term_search(index, "text", "red").collect()) == ["x", "x"]
    assert index.docs.count() == 3
    fl.delete_documents(spark, path, index.docs.orderBy("batch").limit(1))
    assert se.term_search(fl.open_index(spark, path), "text", "red").count() == 1


def test_two_writers_at_once(spark, tmp_path):
    path = str(tmp_path / "index")
    fl.write_index(fields_of(spark, texts(2)), path)
    failures = []

    def add(n):
        try:
            fl.write_index(fields_of(spark, texts(2, 2 + 2 * n)), path, "append")
        except Exception as error:  # shown by the assertion below
            failures.append(error)

    writers = [threading.Thread(target=add, args=(n,)) for n in range(4)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert not failures
    index = fl.open_index(spark, path)
    assert {r.doc_id for r in index.docs.collect()} == {f"d{k}" for k in range(10)}
    assert len(set(batches(spark, path))) == 5


def test_a_late_merge_or_deletion_does_not_count(spark, tmp_path):
    path = str(tmp_path / "index")
    for n in range(2):
        fl.write_index(fields_of(spark, texts(2, 2 * n)), path, "create" if n == 0 else "append")
    log = fl._Log(spark, path)
    before = log.state()
    fl.merge_batches(spark, path, everything=True)
    late = log.claim()
    log.commit(late, log.rows(list(before.batches)).groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("total").alias("total")), "merge", before.last, before.batches)
    assert late not in log.state().batches
    assert {r.doc_id for r in fl.open_index(spark, path).docs.collect()} == {f"d{k}" for k in range(4)}


def test_an_unfinished_claim_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "index")
    fl.write_index(fields_of(spark, texts(1)), path)
    assert fl._Log(spark, path).claim() == 1
    fl.write_index(fields_of(spark, texts(1, 1)), path, "append")
    assert batches(spark, path) == (0, 2)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_best_hits_by_blocks(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(fl, "FREQUENT", 30)
    rows = []
    for k in range(3000):  # forty documents in a thousand say much of the same in few words
        rich = k % 1000 < 40
        words = ["th"] * (20 if rich else 1 + k % 2) + ["of"] * (k % 5) + [f"w{k % 400}", "er" if k % 3 else "la"]
        rows.append((k, " ".join(words + ["x"] * (2 if rich else 30 + k % 7))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    path = str(tmp_path / "index")
    fl.write_index(fl.fields_of_columns(docs.where("cast(doc_id as bigint) < 2000"), "doc_id", text="text"), path)
    rest = docs.where("cast(doc_id as bigint) >= 2000")
    index = fl.write_index(fl.fields_of_columns(rest.withColumn("doc_id", F.expr(f"cast(cast(doc_id as bigint) - {2000 if kind == 'bigint' else 0} as {kind})")), "doc_id", text="text"), path, "append")
    queries = [(1, "th er"), (2, "la"), (3, "w17 th"), (4, "w5"), (5, "zzz"), (6, "x x w399 la er"), (7, None)]
    frame = spark.createDataFrame(queries, "query_id int, text string")
    rounded = F.round("score", 6)

    def cut(hits):
        best = top_k_per_query(hits.withColumn("score", rounded))
        return {(r.query_id, r.doc_id, r.score, r.rank) for r in best.collect()}

    found = be.best_hits_batch(index, "text", frame)
    whole = se.any_words_batch(index, "text", frame)
    assert cut(found) == cut(whole)
    assert found.count() < whole.count() / 2
    weighted = be._weighted(index, "text", frame, be.words_standard)
    kept = be.surviving_blocks(index, "text", weighted.where("query_id = 3")).count()
    assert kept < be.block_bounds(index, "text", weighted.where("query_id = 3")).count() / 3
    assert be.best_hits_batch(index, "text", frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        be.best_hits_batch(fl.build_index(fl.fields_of_columns(docs, "doc_id", text="text")), "text", frame)


def test_clustered_postings_are_not_shuffled(spark, tmp_path):
    index = fl.write_index(fields_of(spark, texts(200)), str(tmp_path / "index"))
    near = cluster_postings(index, 4, str(tmp_path / "near"))
    queries = spark.createDataFrame([(1, "common w1"), (2, "w2 only7 zzz")], "query_id int, text string")
    hits = se.any_words_batch(near, "text", queries)

    def rows(found):
        return sorted((r.query_id, r.doc_id, round(r.score, 9)) for r in found.collect())

    assert rows(hits) == rows(se.any_words_batch(index, "text", queries))
    moved = r"hashpartitioning\(query_id#\d+, batch#"
    assert re.search(moved, plan_of(se.any_words_batch(index, "text", queries)))
    assert not re.search(moved, plan_of(hits)) and "Bucketed: true" in plan_of(hits)
    again = qt.phrase_batch(near, "text", queries.selectExpr("query_id", "'common w1' text", "0 slop"))
    assert rows(again) == rows(qt.phrase_batch(index, "text", queries.selectExpr("query_id", "'common w1' text", "0 slop")))


def test_total_and_best_in_one_pass(spark, tmp_path):
    index = fl.write_index(fields_of(spark, texts(30)), str(tmp_path / "index"))
    best, total = be.top_k_with_total(qt.query_search(index, "text", "common -w1"), 4)
    assert total == qt.query_search(index, "text", "common -w1").count()
    assert best.count() == 4


def test_buckets_grow_with_the_postings(spark, tmp_path, monkeypatch):
    from corpusloom.operators import clustered

    index = fl.write_index(fields_of(spark, texts(200)), str(tmp_path / "index"))
    monkeypatch.setattr(clustered, "BUCKET_ROWS", 50)
    near = cluster_postings(index, 4, str(tmp_path / "near"))
    assert "out of 16" in plan_of(near.postings.groupBy("doc_id").count())
    assert near.postings.count() == index.postings.count()


def test_large_batches_are_added_up_by_document(spark, tmp_path, monkeypatch):
    index = fl.write_index(fields_of(spark, texts(200)), str(tmp_path / "index"))
    queries = spark.createDataFrame([(1, "common w1"), (2, "w2 only7 zzz"), (3, "common")], "query_id int, text string")

    def rows(found):
        return sorted((r.query_id, r.doc_id, round(r.score, 9)) for r in found.collect())

    whole = rows(se.any_words_batch(index, "text", queries))
    monkeypatch.setattr(se, "BATCH_ROWS", 20)
    hits = se.any_words_batch(index, "text", queries)
    tasks = int(re.search(r"hashpartitioning\(batch#\d+, doc_id#\d+L?, (\d+)\)", plan_of(hits))[1])
    assert tasks >= len(whole) / 20 and not re.search(r"hashpartitioning\(query_id#\d+, batch#", plan_of(hits))
    assert rows(hits) == whole
    monkeypatch.setattr(se, "fits_broadcast", lambda df: False)
    assert rows(se.any_words_batch(index, "text", queries)) == whole


def test_postings_are_stored_by_term_first(spark, tmp_path):
    """A field is the same in most rows, so a sort that begins with it compares all of them as a whole."""
    docs = spark.createDataFrame([("1", "b a", "c"), ("2", "a", "a d")], "doc_id string, text string, title string")
    path = str(tmp_path / "index")
    index = fl.write_index(fl.fields_of_columns(docs, "doc_id", title="title", text="text"), path)
    fl.write_index(fl.fields_of_columns(docs, "doc_id", title="title", text="text"), path, "append")
    fl.merge_batches(spark, path, everything=True)
    for number in (0, 1, 2):
        for table in ("postings", "vocabulary"):
            rows = spark.read.parquet(f"{path}/{table}/batch={number}").coalesce(1).select("term", "field")
            assert {tuple(r) for r in rows.collect()} == {("b", "text"), ("c", "title"), ("d", "title")} | set()
            per_file = rows.select("term", "field", F.input_file_name().alias("file")).collect()
            for file in {r.file for r in per_file}:
                held = [(r.term, r.field) for r in per_file if r.file == file]
                assert held == sorted(held)

