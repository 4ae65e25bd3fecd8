"""Mixing: the Pfair bound at every slot, quotas, places in a source, edges."""

from fractions import Fraction

import pytest
from corpusloom.llm import mixing
from corpusloom.llm.queries import op6_pfair_mixing
from pyspark.sql import functions as F


@pytest.mark.parametrize("parts", [[1000], [333, 334, 333], [1, 999], [500, 250, 125, 60, 33, 17, 9, 3, 2, 1], [40] * 25])
def test_period(spark, parts):
    frame = spark.createDataFrame([(f"s{k:02d}", p) for k, p in enumerate(parts)], "source string, parts int")
    rows = sorted(mixing.period(frame).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(1000))
    weight = {f"s{k:02d}": Fraction(p, 1000) for k, p in enumerate(parts)}
    had = dict.fromkeys(weight, 0)
    for r in rows:
        assert r.nth == had[r.source]
        assert r.release == had[r.source] // weight[r.source] and r.due == -(-(had[r.source] + 1) // weight[r.source])
        assert r.release <= r.slot < r.due
        had[r.source] += 1
        for source, w in weight.items():
            assert abs(had[source] - w * (r.slot + 1)) < 1


def docs_of(spark, sizes, chars=10):
    rows, n = [], 0
    for source, count in sizes.items():
        rows += [(n + k, source, "x" * chars) for k in range(count)]
        n += count
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string")


def check_bound(rows, parts, block, chars):
    """Characters of each source by slot are less than a block from its share, while all last."""
    slots = {}
    for r in rows:
        if r.kept:
            slots.setdefault(r.slot, set()).add(r.source)
    assert all(len(s) == 1 for s in slots.values())
    had = dict.fromkeys(parts, 0)
    for slot in range(min(max(slots) + 1, 800)):
        for source in slots.get(slot, ()):
            had[source] += 1
        if slot in slots:
            assert all(abs(had[s] - Fraction(p, 1000) * (slot + 1)) < 1 for s, p in parts.items())


def test_target_weights(spark):
    docs = docs_of(spark, {"a": 3000, "b": 4000, "c": 900, "unused": 50})
    rows = mixing.mix(docs, {"a": 5, "b": 3, "c": 2}, block_chars=40).collect()
    kept = {s: sum(r.kept for r in rows if r.source == s) for s in ("a", "b", "c", "unused")}
    assert kept == {"a": 2250, "b": 1350, "c": 900, "unused": 0}
    check_bound(rows, {"a": 500, "b": 300, "c": 200}, 40, 10)
    assert all(r.slot is None and r.place is None for r in rows if not r.kept)


def test_share_of_a_large_source_is_held(spark):
    docs = docs_of(spark, {"hot": 6000, "b": 1500, "c": 1500, "d": 1500, "e": 1, "f": 1, None: 1})
    rows = mixing.mix(docs, block_chars=40, max_share=0.3).collect()
    kept = {s: sum(r.kept for r in rows if r.source == s) for s in ("hot", "b", "c", "d", "e", "f", None)}
    assert kept["b"] == kept["c"] == kept["d"] == 1500 and kept[None] == 1
    assert abs(kept["hot"] / sum(kept.values()) - 0.3) < 0.001
    assert {r.source for r in mixing.mixed(docs, block_chars=40, max_share=0.3).collect()} == set(kept)


def plain_quotas(sizes, epochs, weights=None, exponent=0.7):
    """Target weights by the rule, then the shortest mix that uses every character."""
    if weights:
        known = sum(sizes[s] for s in sizes if s in weights)
        raw = {s: weights[s] if s in weights else n * sum(weights[s] for s in sizes if s in weights) / known for s, n in sizes.items()}
    else:
        raw = {s: float(n) ** exponent for s, n in sizes.items()}
    total = sum(raw.values())
    length = min(max(n / (raw[s] / total) for s, n in sizes.items()), epochs * sum(sizes.values()))
    return {s: max(n, min(epochs * n, round(raw[s] / total * length))) for s, n in sizes.items()}


@pytest.mark.parametrize(("weights", "epochs"), [(None, 4), ({"a": 5, "b": 3, "c": 2}, 4), ({"a": 1, "b": 1}, 2), (None, 1)])
def test_targets_with_epochs(spark, weights, epochs):
    counts = {"a": 600, "b": 350, "c": 45, "d": 20}
    docs = docs_of(spark, counts)
    found = mixing.mix(docs, weights, block_chars=20, epochs=epochs)
    quotas = plain_quotas({s: 10 * n for s, n in counts.items()}, epochs, weights)
    rows = found.collect()
    total = sum(quotas.values())
    for source, quota in quotas.items():
        mine = [r for r in rows if r.source == source]
        assert len({r.doc for r in mine}) == counts[source] and all(r.kept for r in mine)
        assert len(mine) == -(-quota // 10) and max(r.epoch for r in mine) < epochs
        assert len({(r.doc, r.epoch) for r in mine}) == len(mine)
    if weights and epochs == 4 and len(weights) == 3:
        assert abs(quotas["a"] / quotas["b"] - 5 / 3) < 0.01
    had = dict.fromkeys(quotas, 0)
    taken = {r.slot: r.source for r in rows}
    for n, slot in enumerate(sorted(taken)[: total // 20 - 4], 1):
        had[taken[slot]] += 1
        assert all(abs(had[s] - Fraction(q * n, total)) < 1 for s, q in quotas.items())
    copies = mixing.mixed(docs, weights, epochs=epochs)
    assert copies.columns == docs.columns
    assert sorted(r.doc_id for r in copies.collect()) == sorted(r.doc for r in rows)


def test_order_of_repeated_documents(spark, tmp_path):
    docs = docs_of(spark, {"a": 300, "b": 100, "c": 30})
    mixing.mixed(docs, epochs=4).write.parquet(str(tmp_path / "mixed"))
    stored = spark.read.parquet(str(tmp_path / "mixed"))
    assert stored.count() > docs.count()
    rows = mixing.scheduled(stored, block_chars=20).orderBy("slot", "place").collect()
    assert len(rows) == stored.count()
    quotas = plain_quotas({"a": 3000, "b": 1000, "c": 300}, 4)
    had = dict.fromkeys(quotas, 0)
    for n, r in enumerate(rows[:-8], 1):
        had[r.source] += 10
        assert all(abs(had[s] - Fraction(q * 10 * n, sum(quotas.values()))) < 2 * 20 for s, q in quotas.items())


def test_epochs_of_odd_tables(spark):
    rows = [(1, None, None), (2, "a", ""), (2, "a", ""), (None, "a", "x"), (3, "b", "y" * 5000), (4, "c", "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").selectExpr("*", "1 parts", "2 slot", "3 kept", "4 epoch", "5 key")
    copies = mixing.mixed(docs, epochs=4)
    assert copies.columns == docs.columns and {r.doc_id for r in copies.collect()} == {1, 2, 3, 4, None}
    assert copies.where("source = 'c'").count() == 4 and copies.where("doc_id = 3").count() == 1
    assert mixing.mixed(docs.limit(0), epochs=4).count() == 0
    assert mixing.scheduled(docs.limit(0)).count() == 0
    assert mixing.scheduled(docs).select("doc_id", "slot", "place").where("slot IS NULL").count() == 0


def test_every_row_is_kept_and_paced(spark):
    docs = docs_of(spark, {"hot": 900} | {f"s{k}": 10 for k in range(9)} | {"one": 1})
    rows = mixing.mix(docs, block_chars=10).collect()
    assert all(r.kept for r in rows) and len({r.slot for r in rows}) == len(rows) == 991
    assert mixing.mixed(docs).count() == 991
    had = {}
    for n, r in enumerate(sorted(rows, key=lambda r: r.slot), 1):
        had[r.source] = had.get(r.source, 0) + 1
        assert abs(had["hot"] - Fraction(900, 991) * n) < 1


@pytest.mark.parametrize("ranges", [(1 << 16, 512), (100, 30)])
def test_weights_are_not_rounded(spark, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGE", ranges[0])
    monkeypatch.setattr(mixing, "STRETCH", ranges[1])
    sizes = {"a": 9415, "b": 575, "c": 4, "d": 6}  # b has 5.75 in a hundred, c 0.04
    frame = spark.createDataFrame(list(sizes.items()), "source string, parts bigint")
    rows = sorted(mixing.period(frame, 4).collect(), key=lambda r: r.slot)
    had = dict.fromkeys(sizes, 0)
    for r in rows:
        weight = Fraction(sizes[r.source], 10_000)
        assert r.nth == had[r.source] and r.release == had[r.source] // weight <= r.slot < r.due
        assert r.due == -(-(had[r.source] + 1) // weight)
        had[r.source] += 1
        for source, size in sizes.items():
            behind = Fraction(size, 10_000) * (r.slot + 1) - had[source]
            assert -1 < behind < 1 or had[source] == -(-size // 4)
    assert had == {s: -(-n // 4) for s, n in sizes.items()}
    assert len({r.slot for r in rows}) == len(rows)


def test_many_small_sources(spark):
    docs = docs_of(spark, {f"s{k:04d}": 1 + 3 * (k >= 600) for k in range(1100)})
    rows = mixing.mix(docs, block_chars=10).collect()
    assert len(rows) == len({r.slot for r in rows}) == 2600
    assert all(r.kept and r.release <= r.slot < r.due for r in rows)


def test_places_within_a_source(spark):
    docs = docs_of(spark, {"a": 300, "b": 10}, 7).withColumn("text", F.expr("repeat('x', cast(doc_id % 5 * 9 as int))"))
    laid = mixing.laid_out(docs.selectExpr("*", "1 stripe", "2 key"), "doc_id", "source", "text", 7).collect()
    for source in ("a", "b"):
        rows = sorted((r for r in laid if r.source == source), key=lambda r: r.before)
        upto = 0
        for r in rows:
            assert r.before == upto
            upto += r.chars
        assert [r.key for r in rows] == sorted(r.key for r in rows)


def test_edges(spark):
    rows = [(1, None, None), (2, "a", ""), (2, "a", ""), (None, "a", "x"), (3, "b", "y" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").selectExpr("*", "1 parts", "2 slot", "3 kept")
    found = mixing.mix(docs, block_chars=64, max_share=1.0)
    assert found.count() == 5 and found.where("kept").count() == 5
    kept = mixing.mixed(docs, block_chars=64, max_share=0.9)
    assert kept.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    rows = op6_pfair_mixing(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs) and all(r.kept for r in rows)
    sizes, had = {}, {}
    for d in docs.values():
        sizes[d.source] = sizes.get(d.source, 0) + max(1, len(d.text))
    longest = {}
    for r in rows:
        n = max(1, len(docs[r.doc_id].text))
        had[r.source] = had.get(r.source, 0) + n
        longest[r.source] = max(n, longest.get(r.source, 0))
    for source, quota in plain_quotas(sizes, 4).items():
        assert quota <= had[source] < quota + longest[source]
    slots = {}
    for r in rows:
        slots.setdefault(r.slot, r.source)
        assert slots[r.slot] == r.source and r.release <= r.slot < r.due
