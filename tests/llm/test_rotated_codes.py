"""Embedding duplicates: exact links against all pairs, estimates, edge cases."""

import numpy as np
from corpusloom.llm import rotated_codes as rc
from corpusloom.llm.queries import op10_embedding_near_dedup


def plain(rows, components_of, threshold=0.93):
    """All pairs of usable vectors of one label."""
    usable = {}
    for vec_id, vector, label in rows:
        ok = vector is not None and label is not None and len(vector) and all(x is not None and np.isfinite(x) for x in vector)
        if ok and any(vector):
            usable[vec_id] = (label, np.array(vector) / np.abs(vector).max())
    links, n = [], {r[0]: 0 for r in rows}
    for a, (la, va) in usable.items():
        for b, (lb, vb) in usable.items():
            if a < b and la == lb and len(va) == len(vb):
                if va @ vb / (np.linalg.norm(va) * np.linalg.norm(vb)) >= threshold:
                    links.append((a, b))
                    n[a] += 1
                    n[b] += 1
    root = components_of(n, links)
    return {(v, n[v], root[v], v == root[v]) for v in n}


def test_query_against_all_pairs(spark, sf_dir, components_of):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = set(map(tuple, op10_embedding_near_dedup(spark, sf_dir).collect()))
    assert found == plain(rows, components_of)


def test_edges_and_a_crowded_group(spark, components_of):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(24)
    rows = [(i, (centre + rng.normal(0, 0.2, 24)).tolist(), 1) for i in range(700)]
    rows += [(700 + i, centre.tolist(), 1) for i in range(30)] + [(800, (centre * 3).tolist(), 2)]
    rows += [(801, (centre * 1e-200).tolist(), 2), (802, (centre * 1e200).tolist(), 2), (803, [1.0, 2.0], 2), (804, [2.0, 4.1], 2)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [float("nan")] * 24, 1), (904, [None] * 24, 1)]
    rows += [(905, [float("inf")] * 24, 1), (906, centre.tolist(), None), (907, centre.tolist(), None), (908, [1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 id", "2 n", "3 bucket")
    found = {tuple(r) for r in rc.near_duplicate_vectors(frame).collect()}
    assert found == plain(rows, components_of)
    assert rc.near_duplicate_vectors(frame.limit(0)).count() == 0


def test_repeated_ids(spark):
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    rows = [(1, a, 1), (1, a, 1), (2, [1.0, 0.01, 0.1], 1), (2, b, 1), (3, b, 1), (4, b, 2), (4, b, 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    found = sorted(map(tuple, rc.near_duplicate_vectors(frame).collect()))
    assert found == [(1, 2, 1, True), (1, 2, 1, True), (2, 1, 2, True), (2, 2, 1, False), (3, 1, 2, False), (4, 1, 4, True), (4, 1, 4, True)]


def test_tables_grow_with_the_vectors():
    assert rc.table_size(50_000) == rc.table_size(0) == (48, 12)
    tables, bits = rc.table_size(1 << 30)
    assert bits == 24 and 200 < tables < 300
    agree = (1 - np.arccos(0.93) / np.pi) ** bits
    assert (1 - agree) ** tables <= 1e-5


def test_wide_keys_find_the_same(spark, sf_dir, components_of):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()]
    assert set(map(tuple, rc.near_duplicate_vectors(frame, tables=90, bits=18).collect())) == plain(rows, components_of)


def test_full_vectors_are_fetched_for_few(spark):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((3000, 64))
    vectors[1500:1520] = vectors[0] + rng.normal(0, 0.1, (20, 64))
    rows = [(i, v.tolist(), "1", 1) for i, v in enumerate(vectors)]
    classes = spark.createDataFrame(rows, "id bigint, vector array<double>, label string, copies bigint")
    index = rc.indexed(rc.stored_codes(classes, 48, 12))
    doubt = rc.rows_in_doubt(index, 0.93).select("id").distinct()
    assert {0, *range(1500, 1520)} <= {r.id for r in doubt.collect()}
    assert doubt.count() < 1200 and index.count() == 48 * 3000


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    base = rng.standard_normal((4000, 64))
    other = base + rng.standard_normal((4000, 64)) * rng.uniform(0.1, 3, (4000, 1))
    a, code, factor = rc.encode(rc.unit_rows(base))
    b, _, _ = rc.encode(rc.unit_rows(other))
    guess, width = rc.estimate(code, factor, b)
    error = guess - np.einsum("ij,ij->i", a, b)
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= width).all()


def test_recall_of_the_tables():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    e = rng.standard_normal(a.shape)
    e -= np.einsum("ij,ij->i", a, e)[:, None] * a
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    keys = [rc.table_keys(x, rc.TABLES, rc.BITS) for x in (a, 0.93 * a + np.sqrt(1 - 0.93**2) * e)]
    assert (keys[0] == keys[1]).any(axis=1).mean() > 0.999
