import pytest


def plain_components(nodes, links):
    """Smallest reachable node of every node, by repeated replacement."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="session")
def components_of():
    return plain_components


@pytest.fixture(scope="session")
def same_as_sql(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")

    def compare(result, sql):
        reference = connection.execute(sql)
        columns = [c[0] for c in reference.description]
        assert sorted(result.columns) == sorted(columns)
        got = sorted(map(repr, map(tuple, result.select(*columns).collect())))
        assert got == sorted(map(repr, reference.fetchall()))

    return compare
