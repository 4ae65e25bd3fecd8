"""The pipeline against the same decisions taken one after the other in plain Python."""

import hashlib
import zlib

import corpus_pipeline
import numpy as np
from corpusloom.llm import mixing, rule_ensemble

from .test_decontaminate import words
from .test_mixing import plain_quotas
from .test_simhash import all_pairs, plain_fingerprint


def test_stages_on_whole_tables(spark, sf_dir, tmp_path, components_of):
    tokenizers = __import__("tokenizers")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    assert [name.split()[0] for name, _ in corpus_pipeline.STAGES] == ["quality", "SimHash", "benchmark", "source", "token-ID"]

    scored = rule_ensemble.score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    kept = {r.doc_id for r in scored if r.predicted}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert np.mean([d in kept for d, q in labels.items() if q]) > 0.97

    prints = {d: plain_fingerprint(rows[d].text) for d in kept}
    root = components_of(set(prints.values()), all_pairs(prints.values(), 4))
    first = {}
    for d, p in prints.items():
        first[root[p]] = min(d, first.get(root[p], d))
    kept = set(first.values())

    windows = set()
    for item in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words(item.text)
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
        assert len(w) >= 10
    clean = set()
    for d in kept:
        w = words(rows[d].text)
        if not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9)):
            clean.add(d)
    assert clean < kept

    sizes, members = {}, {}
    for d in clean:
        source = rows[d].source
        sizes[source] = sizes.get(source, 0) + max(1, len(rows[d].text))
        members.setdefault(source, []).append(d)
    quotas = plain_quotas(sizes, mixing.EPOCHS)
    expected = []
    for source, found in members.items():
        found.sort(key=lambda d: (hashlib.md5(f"7:{d}".encode()).hexdigest(), d))
        upto = 0
        while upto < quotas[source]:
            for d in found:
                if upto < quotas[source]:
                    expected.append(d)
                    upto += max(1, len(rows[d].text))
    assert len(expected) > len(clean) == len(set(expected))

    encoder = tokenizers.Tokenizer.from_file(corpus_pipeline.tokenizer_file())
    result = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()), key=lambda r: r[1])
    assert sorted(r[0] for r in result) == sorted(expected)
    start = 0
    for doc, begins, size, crc in result:
        ids = np.array([*encoder.encode(rows[doc].text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (begins, size, crc) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += size
    assert [r[0] for r in result] != sorted(expected)
