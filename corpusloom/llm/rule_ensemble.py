"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Trees are grown on a bounded sample of labelled documents; every path from a root is a rule, a
conjunction of bounds on statistics. A lasso logistic regression weighs the rules
and drops most. What is left is compiled into one column expression, so that all documents
are scored where they are scanned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from .tables import saved

SAMPLE_ROWS = 20_000
TREES = 16
DEPTH = 3
LASSO = 0.002
SEED = 17

STATISTICS = [
    "log_chars", "word_chars", "symbols", "capitals", "digits", "distinct_words", "distinct_lines", "stops", "lines",
    "vocabulary",
]

Bound = tuple[str, str, float]


def statistics_of(text: str) -> Column:
    """The statistics of a text as an array in the order of :data:`STATISTICS`."""
    held = F.coalesce(F.col(text), F.lit(""))
    size = F.greatest(F.char_length(held), F.lit(1))
    words, lines = F.split(held, " "), F.split(held, "\n")
    n_words = F.greatest(F.size(words), F.lit(1))

    def left(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(held, pattern, ""))

    return F.array(
        F.log1p(F.char_length(held)),
        F.char_length(held) / n_words,
        left(r"[\p{L}\p{N}\s.,]+") / size,
        left(r"[^\p{Lu}]+") / size,
        left(r"[^\p{N}]+") / size,
        F.size(F.array_distinct(words)) / n_words,
        F.size(F.array_distinct(lines)) / F.size(lines),
        (F.char_length(held) - F.char_length(F.replace(held, F.lit("."), F.lit("")))) / n_words,
        F.size(lines) / n_words,
        F.log1p(F.size(F.array_distinct(words))) / F.log1p(n_words),  # hardly falls with length
    )


def rules_of(tree: str) -> list[tuple[Bound, ...]]:
    """The paths from the root of a tree, as MLlib prints it, to each of its other nodes."""
    rules, path = [], []
    for line in tree.splitlines():
        match = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)", line)
        if match:
            indent, feature, side, bound = len(match[1]), int(match[2]), match[3], float(match[4])
            path = [p for p in path if p[0] < indent] + [(indent, (STATISTICS[feature], side, bound))]
            rules.append(tuple(p[1] for p in path))
    return rules


def _merged(rule: tuple[Bound, ...]) -> tuple[Bound, ...]:
    """The tightest bound on each side of each statistic."""
    held: dict[tuple[str, str], float] = {}
    for name, side, bound in rule:
        old = held.get((name, side), bound)
        held[name, side] = min(old, bound) if side == "<=" else max(old, bound)
    return tuple(sorted((name, side, bound) for (name, side), bound in held.items()))


def _holds(rule: tuple[Bound, ...], statistics: Column) -> Column:
    held = F.lit(True)
    for name, side, bound in rule:
        value = statistics[STATISTICS.index(name)]
        held = held & ((value <= bound) if side == "<=" else (value > bound))
    return held


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; :meth:`score` is their logistic sum as a column expression."""

    intercept: float
    rules: list[tuple[tuple[Bound, ...], float]]

    def score(self, statistics: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(_holds(rule, statistics), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(sample: DataFrame) -> RuleModel:
    """Model from rows ``(label, statistics)``; the sample is read some dozens of times.

    With labels of one kind only, or none, the score is that label, or a half.
    """
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return RuleModel({0.0: -20.0, 1.0: 20.0}.get(next(iter(counts), None), 0.0), [])
    grown = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=5,
        subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=SEED,
    ).fit(sample.select("label", array_to_vector("statistics").alias("features")))
    rules = sorted({_merged(rule) for tree in grown.trees for rule in rules_of(tree.toDebugString)})
    if not rules:
        return RuleModel(0.0, [])
    flags = F.array(*[_holds(rule, F.col("statistics")).cast("double") for rule in rules])
    weighed = LogisticRegression(
        labelCol="label", featuresCol="features", elasticNetParam=1.0, regParam=LASSO, maxIter=40, tol=1e-5
    ).fit(sample.select("label", array_to_vector(flags).alias("features")))
    kept = [(rule, float(w)) for rule, w in zip(rules, weighed.coefficients.toArray()) if w]
    return RuleModel(float(weighed.intercept), kept)


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from training: every third by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``(label, statistics)`` of about ``sample_rows`` labelled documents at most.

    Labels are thinned by a hash of the id; what is left is bounded and broadcast. An
    id with labels of both kinds or none is not learnt from.
    """
    usable = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("_labelled"))
        .agg(F.min(label).cast("double").alias("label"), F.max(label).cast("double").alias("high"))
        .where(F.col("label") == F.col("high"))
    )
    share = min(1.0, sample_rows / max(1, usable.count()))
    few = usable.where(
        F.pmod(F.xxhash64("_labelled"), F.lit(1 << 20)) < F.lit(round(share * (1 << 20)))
    ).select("_labelled", "label")
    found = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(few), F.col("_id") == F.col("_labelled")
    )
    return saved(found.select("label", statistics_of("_text").alias("statistics")).repartition(2), "training-rows")


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    Labels are learnt from rows that aren't held out; only statistics of the text enter a score.
    Null texts count as empty and get a score like any other; a null id is never learnt
    from. Columns of these names in ``docs`` are replaced. An empty table gives an
    empty result.
    """
    model = fit(training_rows(docs, labels, doc_id, text, label, sample_rows))
    scored, statistics = _scored(docs, model, text)
    return (
        scored.withColumn("held_out", held_out(F.col(doc_id)))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .drop(statistics)
    )


def _scored(docs: DataFrame, model: RuleModel, text: str, score: str = "score") -> tuple[DataFrame, str]:
    """``docs`` with a score, and the name of the column of statistics it was made from."""
    name = "_statistics"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, statistics_of(text)).withColumn(score, model.score(F.col(name))), name


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` without what the classifier rejects, its columns unchanged."""
    model = fit(training_rows(docs, labels, doc_id, text, label, sample_rows))
    name = "_score"
    while name in docs.columns:
        name += "_"
    scored, _ = _scored(docs, model, text, name)
    # A filter on the score itself would move below the statistics and work them out for every rule.
    good = scored.select(*docs.columns, F.explode(F.array(F.col(name) >= 0.5)).alias(name))
    return good.where(F.col(name)).select(*docs.columns)
