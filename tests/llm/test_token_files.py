"""Token files: ids against encoding whole texts, random access, edges."""

import zlib

import numpy as np
import pytest
from corpusloom.llm import token_files as tf
from corpusloom.llm.queries import op4_token_id_files, tokenizer_file
from hypothesis import given, settings, strategies as st

PATH = tokenizer_file()


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(PATH)
    return lambda text: encoder.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def cache():
    return tf.WordCache(PATH)


def expected(rows, plain):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = np.array([*plain(text), 2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_against_whole_texts(spark, sf_dir, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op4_token_id_files(spark, sf_dir).collect())) == expected(rows, plain)


ODD = ["", " ", "\n\n", "it's we'll I'M", "a.b,c!? (x)", "ÀÉß ÿ µª", "İstanbul ŉ", "é ́x ≮",
       "<|endoftext|> x<|ENDOFTEXT|>y <|startoftext|>z", "a\x1cb\x85c\xa0d　e\tf\x0bg", "１２ 12a3 ½", "日本語 中文", "😀a😀",
       "Word. word, WORD!!", "#hash", "x" * 5000, "''s 's", "ΣΑΣ ΟΔΟΣ"]


def test_odd_texts(cache, plain):
    for _ in range(2):
        assert [ids.tolist() for ids in cache.encode(ODD)] == [plain(t) for t in ODD]


def test_case_of_marks_and_composed_letters(cache, plain):
    texts = ["x <|EndOfText|> y", "<|ENDOFTEXT|>", "J\u030c", "T\u0308 H\u0331 W\u030a Y\u030a xJ\u030c.", "MÜNCHEN. Über THE The the"]
    found = [ids.tolist() for ids in cache.encode(texts)]
    assert found == [plain(t) for t in texts]
    assert found[0] == [343, 27, 347, 40786, 4160, 91, 285, 344] and found[2] == [329, 136, 490]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAB é'.,!-\n\t́<|>1İß  "), max_size=40), max_size=5))
def test_any_texts(cache, plain, texts):
    assert [ids.tolist() for ids in cache.encode(texts)] == [plain(t) for t in texts]


def test_long_texts_and_a_full_cache(cache, plain, monkeypatch):
    monkeypatch.setattr(tf, "PIECE", 64)
    monkeypatch.setattr(tf, "CACHED_WORDS", 20)
    texts = [" ".join(f"wörd{i % 97}x," for i in range(200)), "short", " " * 300 + "end"]
    assert [ids.tolist() for ids in cache.encode(texts)] == [plain(t) for t in texts]


def test_files(spark, tmp_path, plain, monkeypatch):
    rows = [(5, "five words are in here"), (None, None), (3, ""), (3, "again"), (9, "z " * 700), (-2, "minus")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 shard", "'f' file")
    manifest = tf.write_token_files(docs, str(tmp_path / "t"), PATH, length=16)
    found = tf.read_documents(manifest).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected(rows, plain)
    for shard in manifest.collect():
        held, k = [], 0
        while len(held) < shard.n_ids:
            ids, mask = tf.sequence(shard.file, k)
            assert len(ids) == len(mask) == 16
            held += ids[mask].tolist()
            k += 1
        assert len(held) == shard.n_ids
    assert not [p.name for p in (tmp_path / "t").iterdir() if "_draft" in p.name]
    empty = tf.write_token_files(docs.limit(0), str(tmp_path / "e"), PATH)
    assert tf.read_documents(empty).count() == 0


def test_words_kept_are_bounded():
    cache, letters = tf.WordCache(PATH), "abcdefghij"
    for low in range(0, 300_000, 20_000):
        words = ("w" + "".join(letters[int(d)] for d in str(n)) for n in range(low, low + 20_000))
        list(cache.encode([" ".join(words)]))
    assert len(cache.known) + len(cache.older) <= 250_000


def test_words_kept_are_compact():
    cache = tf.WordCache(PATH)
    list(cache.encode([" ".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{chr(97 + n // 676)}" for n in range(10_000))]))
    assert len(cache.known) == 10_000
    assert cache.known.nbytes + cache.ids.nbytes < 64 * len(cache.known)
