"""Scores from tables against products, the query against SQL, edge cases against plain Python."""

import math

import numpy as np
from corpusloom.llm import hard_negatives as hn
from corpusloom.llm.oracles import ORACLES
from corpusloom.llm.queries import op11_hard_negatives
from pyspark.sql import functions as F


def plain(rows, every=100, positives=5, negatives=10):
    usable = []
    for vec_id, vector, label in rows:
        if None in (vec_id, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        integers = [math.floor(256 * x) for x in vector]
        if all(abs(i) < math.sqrt(2**63 / len(vector)) - 1 for i in integers):
            usable.append((vec_id, label, integers))
    found = []
    for a, (anchor, label, mine) in enumerate(usable):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(mine, v)), vec_id, other == label)
            for b, (vec_id, other, v) in enumerate(usable)
            if a != b and len(v) == len(mine)
        ]
        for score, positive, _ in sorted(s for s in scored if s[2])[:positives]:
            band = sorted(s for s in scored if not s[2] and 30 * -score <= 100 * -s[0] <= 90 * -score)
            found += [(anchor, positive, n, s[1], -score, -s[0]) for n, s in enumerate(band[:negatives], 1)]
    return sorted(found)


def test_query_against_sql(spark, sf_dir, same_as_sql):
    result = op11_hard_negatives(spark, sf_dir)
    same_as_sql(result, ORACLES["op11_hard_negatives"])
    assert result.count() > 100


def test_scores_are_exact():
    rng = np.random.default_rng(4)
    for size in (0, 1, 7, 8, 9, 64, 100):
        for top, planes in ((1, 3), (255, 9), (1 << 28, 30)):
            a, b = (rng.integers(-top, top, (30, size), endpoint=True) for _ in range(2))
            bits = hn.pack(b, planes)
            assert (hn.unpack(bits, size) == b).all()
            assert (hn.scores(hn.subset_sums(a, np.int64), bits) == b @ a.T).all()
            if top < 256:
                assert (hn.scores(hn.subset_sums(a, np.int32), bits) == b @ a.T).all()


def test_edges_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(hn, "CELL_ROWS", 16)
    monkeypatch.setattr(hn, "STRIPE_ROWS", 2)
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-3, 4, 11).astype(float).tolist(), int(i % 3)) for i in range(0, 260, 4)]
    rows += [(200, [1.0] * 11, 1), (200, [1.0] * 11, 1), (200, [1.0] * 11, 2), (300, [0.0] * 11, 0)]
    rows += [(400 + i, [1.0] * 11, 2) for i in range(30)] + [(500 + i, [0.5] * 11, 0) for i in range(30)]
    rows += [(600, [1.0, 2.0], 1), (601, [1.0, 2.0], 1), (602, [0.5, 1.0], 2), (700, [], 1), (701, [], 2), (702, [], 1)]
    rows += [(800, None, 1), (801, [None] * 11, 1), (802, [float("nan")] * 11, 1), (803, [float("inf")] * 11, 1)]
    rows += [(None, [1.0] * 11, 1), (900, [1.0] * 11, None), (1000, [1e6] * 11, 0), (1001, [9e5] * 11, 0), (1002, [7e5] * 11, 1)]
    rows += [(1003, [1e200] * 11, 0), (1004, [-1e300] * 11, 0), (1100, [1e-300] * 11, 1), (1200, [-0.001] * 11, 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 row", "2 cell", "3 anchor", "4 place")
    found = hn.mine(frame, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == plain(rows)
    assert hn.mine(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hn.mine(frame.where("vec_id % 100 <> 0"), F.col("vec_id") % 100 == 0).count() == 0
