"""Documents to packed token files: filter, deduplicate, decontaminate, mix, tokenize.

Each stage works on all that the one before has kept, written as a table in the shared folder.
Stages but the last return the columns of ``documents``. Null texts are empty ones, repeated rows are rows like others
until near-duplicates go, an empty table gives empty tables; see the operators for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontaminate, mixing, rule_ensemble, simhash, token_files
from corpusloom.llm.queries import tokenizer_file
from corpusloom.llm.tables import saved, table
from corpusloom.plans.scratch import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble doesn't reject."""
    return rule_ensemble.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of short sources in up to four epochs: weights are sizes to the power 0.7."""
    return mixing.mixed(docs, epochs=mixing.EPOCHS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left in the order of the mix, and where each document is in them."""
    manifest = token_files.write_token_files(
        mixing.scheduled(docs), scratch_path(spark, "tokens"), tokenizer_file(), order=("slot", "place")
    )
    return token_files.read_documents(manifest)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
    ("token-ID output", token_output),
]

#: A fitted model, 64-bit hashes and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
