"""Rule ensemble: held-out accuracy, rules against their trees, edges."""

import zlib

from corpusloom.llm import rule_ensemble as re_
from corpusloom.llm.queries import op5_quality_rule_ensemble
from pyspark.sql import functions as F

TREE = """DecisionTreeClassificationModel: depth=2, numNodes=5, numClasses=2, numFeatures=9
  If (feature 2 <= 0.25)
   If (feature 0 <= 1.5E-4)
    Predict: 0.0
   Else (feature 0 > 1.5E-4)
    Predict: 1.0
  Else (feature 2 > 0.25)
   Predict: 0.0
"""


def test_rules_of_a_tree():
    low, high = ("symbols", "<=", 0.25), ("symbols", ">", 0.25)
    assert re_.rules_of(TREE) == [(low,), (low, ("log_chars", "<=", 1.5e-4)), (low, ("log_chars", ">", 1.5e-4)), (high,)]
    assert re_._merged((low, ("symbols", "<=", 0.1), high)) == (("symbols", "<=", 0.1), ("symbols", ">", 0.25))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op5_quality_rule_ensemble(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q in judged if q], [s for s, q in judged if not q]
    assert sum(s >= 0.5 for s in good) / len(good) > 0.98 and sum(s < 0.5 for s in bad) / len(bad) > 0.95
    ranked = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert ranked > 0.98


def test_model_is_its_rules(spark):
    rule = (("symbols", ">", 0.2), ("lines", "<=", 0.5))
    model = re_.RuleModel(-1.0, [(rule, 3.0)])
    texts = spark.createDataFrame([("a b c",), ("$$$ ### %%%",)], "text string")
    scores = [r[0] for r in texts.select(model.score(re_.statistics_of("text"))).collect()]
    assert [round(s, 4) for s in scores] == [0.2689, 0.8808]


def test_edges(spark):
    rows = [(1, None, 5), (2, "", 6), (None, "a good text", 7), (4, "x " * 60_000, 8), (4, "x " * 60_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int").selectExpr("*", "9 statistics", "1 label")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (4, None, 1)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        found = re_.score_documents(docs, some)
        assert found.count() == 5 and found.where(F.col("score").between(0, 1)).count() == 5
    kept = re_.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == 5
    assert {r.score for r in kept.collect()} == {5, 6, 7, 8}
    assert re_.score_documents(docs.limit(0), labels).count() == 0
