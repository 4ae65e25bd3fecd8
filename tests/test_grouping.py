"""Postings are written with one sort."""

from corpusloom.operators import fields, postings
from corpusloom.plans import grouping

SETTING = "spark.sql.execution.useObjectHashAggregateExec"


def test_postings_are_grouped_by_the_sort_they_are_written_in(spark, tmp_path, docs_of):
    tokens = postings.positioned_tokens(docs_of("b a b", "a"), stemmed=False).repartitionByRange("term", "doc_id")
    before = spark.conf.get(SETTING, "true")
    with grouping.grouped_by_sorting(spark):
        made = postings.build_postings(tokens).sortWithinPartitions("term", "doc_id")
        plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan and plan.count("Sort [") == 1
    assert spark.conf.get(SETTING, "true") == before


def test_a_stored_index_is_written_with_sorted_groups(spark, tmp_path, docs_of, monkeypatch):
    seen, write = {}, fields._write

    def watched(df, path, table, number):
        seen[table] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, path, table, number)

    monkeypatch.setattr(fields, "_write", watched)
    docs = docs_of("red gear red", "blue gear")
    index = fields.write_index(fields.fields_of_columns(docs, "doc_id", text="text"), str(tmp_path / "index"))
    assert "ObjectHashAggregate" not in seen["postings"]
    found = {(r.term, r.doc_id, tuple(r.positions)) for r in index.postings.collect()}
    assert found == {("red", 0, (1, 3)), ("gear", 0, (2,)), ("blue", 1, (1,)), ("gear", 1, (2,))}
