"""SimHash: fingerprints bit by bit, links against all pairs, edge cases."""

import random

import xxhash
from corpusloom.llm import simhash
from corpusloom.llm.buckets import tiled
from corpusloom.llm.components import connected_components
from corpusloom.llm.queries import op9_simhash_near_dedup
from pyspark.sql import functions as F

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_fingerprint(text):
    words, word = [], ""
    for c in text or "":
        if c in SPACES:
            words += [word] * bool(word)
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    words += [word] * bool(word)
    size = min(4, len(words))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def all_pairs(values, bits):
    values = sorted(set(values))
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= bits]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_against_all_pairs(spark, sf_dir, components_of):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {d: plain_fingerprint(t) for d, t in docs.items()}
    links = all_pairs(prints.values(), 4)
    by_print = components_of(set(prints.values()), links)
    first = {}
    for d, p in prints.items():
        first[by_print[p]] = min(d, first.get(by_print[p], d))
    expected = {(d, f"{p:016x}", first[by_print[p]]) for d, p in prints.items()}
    assert set(map(tuple, op9_simhash_near_dedup(spark, sf_dir).collect())) == expected


def test_links_of_planted_fingerprints(spark, components_of):
    rng = random.Random(3)
    values = set()
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            values.add(signed(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5)))))
    prints = spark.createDataFrame([(v,) for v in values], "fp bigint")
    expected = components_of(values, all_pairs(values, 4))
    found = dict(map(tuple, connected_components(simhash.fingerprint_links(prints)).collect()))
    assert {v: found.get(v, v) for v in values} == expected


def test_crowded_bucket_is_split_without_loss(spark):
    index = spark.range(3000).select(F.lit(7).cast("bigint").alias("bucket"), "id")
    rows = tiled(index, block=500).collect()
    assert {r.parts for r in []} == set()
    meet = {}
    for r in rows:
        meet.setdefault(r.tile, []).append((r.id, r.side, r.own))
    assert max(map(len, meet.values())) < 1400
    a, b = 17, 2444
    together = [
        t for t, held in meet.items()
        if {a, b} <= {i for i, _, _ in held}
        and (all(o for _, _, o in held) or len({s for i, s, _ in held if i in (a, b)}) == 2)
    ]
    assert len(together) == 1


def test_edges(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "One", None), (4, "one", 1), (5, "a b c d e " * 9000, 1), (5, "a b c d e " * 9000, 1), (None, "zz top", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (None, None)}
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 5]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_fingerprint_of_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    monkeypatch.setattr(simhash, "AT_ONCE", 100)
    assert simhash.fingerprint(text) == plain_fingerprint(text)
