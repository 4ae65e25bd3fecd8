"""Rollups: signed changes, batches sent twice, edges."""

import pytest
from corpusloom.llm import rollup
from corpusloom.llm.oracles import ORACLES
from corpusloom.llm.queries import op3_token_count_rollups

SCHEMA = "source string, lang string, tokenizer string, n_tokens bigint"


def held(spark, store):
    return {tuple(r) for r in rollup.totals(spark, store).collect()}


def test_changes(spark, tmp_path):
    store = str(tmp_path / "store")
    assert held(spark, store) == set()
    first = spark.createDataFrame([("a", "en", "1", 10), ("a", "en", "1", 5), (None, None, "1", None), ("b", "de", "1", 7)], SCHEMA)
    first = first.selectExpr("*", "1 n", "2 n_docs")
    assert rollup.apply_batch(spark, store, "b1", rollup.inserts(first))
    assert not rollup.apply_batch(spark, store, "b1", rollup.inserts(first))
    assert held(spark, store) == {("a", "en", "1", 2, 15), (None, None, "1", 1, 0), ("b", "de", "1", 1, 7)}
    old = spark.createDataFrame([("a", "en", "1", 5)], SCHEMA)
    new = spark.createDataFrame([("a", "en", "2", 6)], SCHEMA)
    assert rollup.apply_batch(spark, store, "b2", rollup.revisions(old, new))
    assert rollup.apply_batch(spark, store, "b3", rollup.deletes(first.where("source = 'b'")))
    assert rollup.apply_batch(spark, store, "b4", rollup.inserts(first.limit(0)))
    assert held(spark, store) == {("a", "en", "1", 1, 10), ("a", "en", "2", 1, 6), (None, None, "1", 1, 0)}


def test_uncommitted_attempts_do_not_count(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([("a", "en", "1", 10)], SCHEMA)
    rollup.inserts(rows).write.parquet(f"{store}/changes/b1-lost")
    assert held(spark, store) == set()
    assert rollup.apply_batch(spark, store, "b1", rollup.inserts(rows))
    assert held(spark, store) == {("a", "en", "1", 1, 10)}


def test_an_interrupted_commit_can_be_repeated(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([("a", "en", "1", 10)], SCHEMA)
    (tmp_path / "store" / "locks").mkdir(parents=True)
    (tmp_path / "store" / "locks" / "b1").touch()
    with pytest.raises(RuntimeError):
        rollup.apply_batch(spark, store, "b1", rollup.inserts(rows))
    rollup.release(spark, store, "b1")
    assert rollup.apply_batch(spark, store, "b1", rollup.inserts(rows))
    with pytest.raises(ValueError):
        rollup.apply_batch(spark, store, "b=1", rollup.inserts(rows))


def test_query_against_sql(spark, sf_dir, same_as_sql):
    same_as_sql(op3_token_count_rollups(spark, sf_dir), ORACLES["op3_token_count_rollups"])
