"""Every registered query against its SQL counterpart, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from corpusloom.oracles import all_oracles
from corpusloom.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, duck, sf_dir, name):
    result = entry_points.queries()[name](spark, sf_dir)
    reference = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in reference.description]
    assert sorted(result.columns) == sorted(columns)
    got = sorted(map(repr, (tuple(r) for r in result.select(*columns).collect())))
    assert got == sorted(map(repr, reference.fetchall()))


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["ngram", "n", "first_doc", "first_pos"]
