"""Held-out accuracy, scores against a plain sum over subwords, calibration, edge cases."""

import zlib

import numpy as np
from corpusloom.llm import language_id as li
from corpusloom.llm.queries import op13_language_id


def plain_subwords(text):
    """Buckets of the subwords of a text, one by one."""
    held = "\0" + "".join(c if c.isalpha() else "\0" for c in text.lower()) + "\0"
    found = []
    for n in range(1, li.LONGEST + 1):
        for i in range(len(held) - n + 1):
            run = held[i : i + n]
            if "\0" in run[1:-1] or not run.strip("\0"):
                continue
            h = 0
            for c in run:
                h = (h + ord(c)) * 0x9E3779B1 % 2**32
                h ^= h >> 15
            found.append(h >> 17)
    return found


def model_of(n=3):
    rng = np.random.default_rng(2)
    return li.LanguageModel([f"l{i}" for i in range(n)], rng.normal(size=(li.BUCKETS, n)).astype(np.float32), rng.normal(size=n), 0.7, 0.5)


TEXTS = ["", " 12 !", "Ab", "l'Été là-bas\nDIE Straße", "日本語 x", "a" * 50, "\0\n é", "x y " * 400, "İstanbul ǅ"]


def test_subwords_and_scores(monkeypatch):
    monkeypatch.setattr(li, "SLICE", 97)
    model = model_of()
    logits, known = model.logits(TEXTS)
    for text, found, has_letter in zip(TEXTS, logits, known):
        buckets = plain_subwords(text)
        assert has_letter == any(c.isalpha() for c in text.lower()) == bool(buckets)
        if buckets:
            assert np.allclose(found, model.mapped[buckets].mean(axis=0), atol=1e-4)
        kinds, counts = li.bucket_counts(text)
        assert dict(zip(kinds.tolist(), counts.tolist())) == {b: buckets.count(b) for b in buckets}


def test_held_out_accuracy(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op13_language_id(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    unseen = [r for r in found if r.held_out]
    assert len(unseen) > 20 and np.mean([r.lang_pred == docs[r.doc_id].lang for r in unseen]) > 0.95


def test_only_learnable_rows_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = li.fit(docs)
    other = docs.selectExpr("doc_id", "if(crc32(cast(string(doc_id) AS binary)) % 4 = 2, concat('zzz ', text), text) text",
                            "if(crc32(cast(string(doc_id) AS binary)) % 4 = 2, 'xx', lang) lang")
    again = li.fit(other.unionByName(spark.createDataFrame([(10**9, "abc", None), (None, "abc", "yy")], docs.schema)))
    assert again.languages == model.languages and (again.mapped == model.mapped).all()
    assert (again.temperature, again.least) == (model.temperature, model.least)


def test_edge_cases(spark):
    schema = "doc_id bigint, text string, lang string, score string, accepted int, _found int"
    rows = [(i, "der und die Straße ist gut" if i % 2 else "the and of this is good", "de" if i % 2 else "en", "s", 1, 2) for i in range(60)]
    rows += [(100, None, "de", None, 1, 2), (101, "", "de", None, 1, 2), (102, "12 ... 3", "fr", None, 1, 2), (103, "x" * 600_000, None, None, 1, 2)]
    rows += [(104, "und die Straße", None, None, 1, 2), (None, "the good", None, None, 1, 2), (1, rows[1][1], "de", "s", 1, 2)]
    frame = spark.createDataFrame(rows, schema)
    model = li.fit(frame)
    assert model.languages == ["de", "en"]
    found = li.predict(frame, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].accepted) == ("und", 0.0, False) for i in (100, 101, 102))
    assert by_id[104].lang_pred == "de" and by_id[None].lang_pred == "en" and by_id[103].lang_pred in ("de", "en")
    assert all(r.lang_pred == r.lang for r in found if r.lang and r.doc_id < 100)
    assert li.predict(frame.limit(0), model).count() == 0
    nothing = li.fit(frame.limit(0))
    assert {(r.lang_pred, r.score, r.accepted) for r in li.predict(frame, nothing).collect()} == {("und", 0.0, False), ("und", 1.0, True)}
    alone = li.fit(frame.where("lang = 'de'"))
    assert {r.lang_pred for r in li.predict(frame, alone).collect()} == {"de", "und"}


def test_sample_is_bounded(spark):
    frame = spark.range(3000).selectExpr("0 doc_id", "'gleich' text", "'de' lang")
    frame = frame.unionByName(spark.range(2000).selectExpr("id + 1 doc_id", "concat('text ', id) text", "if(id % 50 = 0, 'en', 'de') lang"))
    few = li.sampled(frame, "doc_id", "text", "lang", sample_rows=100).collect()
    assert len(few) <= 200 and 10 < sum(r.lang == "en" for r in few) < 60


def test_calibration():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 20_000)
    honest = rng.normal(size=(20_000, 3)) * 1.5
    chances = np.exp(honest) / np.exp(honest).sum(axis=1, keepdims=True)
    truth = (chances.cumsum(axis=1) > rng.random(20_000)[:, None]).argmax(axis=1)
    temperature, least = li.calibrate(honest * 4, truth, 0.8)
    assert abs(temperature - 4) < 0.5
    sure = chances.max(axis=1) >= least
    assert 0.78 < (honest.argmax(axis=1) == truth)[sure].mean() < 0.82 and 0 < least < 1
    assert li.calibrate(honest[:0], truth[:0], 0.8) == (1.0, 0.0)
