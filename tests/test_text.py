import re

import pytest

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as tx


def words(spark, text, tokenizer, **options):
    literal = spark.createDataFrame([(text,)], "t string")
    return literal.select(tokenizer(F.col("t"), **options).alias("w")).first()["w"]


def test_alpha_drops_words_with_punctuation(spark):
    assert words(spark, "The cat. The cat sat", tx.words_alpha) == ["the", "the", "cat", "sat"]
    assert words(spark, "the café don't end3 x y\x1cz", tx.words_alpha) == [
        "the", "café", "x", "y", "z",
    ]


def test_alpha_strip_first_keeps_stripped_words(spark):
    got = words(spark, "don't stop. -- 3rd", tx.words_alpha, strip_first=True)
    assert got == ["dont", "stop", "3rd"]


def test_clean_deletes_blanks_and_joins(spark):
    assert words(spark, "Well-known: it's (a) test.", tx.words_clean) == [
        "wellknown", "its", "a", "test",
    ]
    assert words(spark, "a\tb c/d", tx.words_clean) == ["ab", "c/d"]
    assert words(spark, "x~y_z {q} `r` |s| 4", tx.words_clean) == [
        "x~y_z", "{q}", "`r`", "|s|", "4",
    ]


def test_standard_numbers_before_stop_words(spark):
    assert words(spark, "State of the Art-2, don't", tx.words_standard) == [
        "state", "of", "the", "art", "2", "don", "t",
    ]
    assert words(spark, "don't 3.14 a.b. x_y", tx.words_standard, unicode_words=True) == [
        "don't", "3.14", "a.b", "x_y",
    ]
    assert len(tx.STOP_WORDS) == 33


def test_empty_and_null_text(spark):
    for tokenizer in (tx.words_alpha, tx.words_clean, tx.words_standard):
        assert words(spark, " \n ", tokenizer) == []
        assert words(spark, None, tokenizer) is None


def test_ngrams_are_all_windows(spark):
    frame = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    got = [r[0] for r in frame.select(tx.word_ngrams(F.col("w"), 2)).collect()]
    assert got == [["a b", "b c"], [], []]
    got = [r[0] for r in frame.select(tx.word_ngrams(F.col("w"), 3)).collect()]
    assert got == [["a b c"], [], []]


DELETED = re.compile(r'[@#$%^&?<>*()\t=\-;\\\]\["\']')


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=1, max_codepoint=255), max_size=60), min_size=1, max_size=20))
def test_tokenizers_match_plain_python(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select(
        "t", tx.words_alpha(F.col("t")).alias("a"), tx.words_clean(F.col("t")).alias("c")
    ).collect()
    for t, alpha, clean in rows:
        assert alpha == [w.lower() for w in t.split() if w.lower().isalpha()]
        spaced = re.sub(r"[\n\r!.,:]", " ", DELETED.sub("", t.lower()))
        assert clean == [w for w in spaced.split(" ") if w]


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("The quick (\u201cbrown\u201d) fox can\u2019t jump 32.3 feet, right?", "the quick brown fox can\u2019t jump 32.3 feet right".split()),
        ("cafe\u0301s Ze\u200dro", ["cafe\u0301s", "ze\u200dro"]),
        ("日本語 テスト ひら한국어", ["日", "本", "語", "テスト", "ひ", "ら", "한국어"]),
        ("カタカナー語x", ["カタカナー", "語", "x"]),
        ("สวัสดี a", ["สวัสดี", "a"]),
        ("1,000.5 3,a a:b x.1 1.x _a_ __ a_1 O'Neil's", ["1,000.5", "3", "a", "a:b", "x", "1", "1", "x", "_a_", "a_1", "o'neil's"]),
        ("\u0301 x\u0301\u0302y", ["x\u0301\u0302y"]),
        ("z" * 600, ["z" * 255, "z" * 255, "z" * 90]),
        ("", []),
    ],
)
def test_word_segmentation(spark, text, words):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(tx.words_standard(F.col("t"), unicode_words=True)).first()[0] == words


def test_one_byte_lengths(spark):
    from corpusloom.functions.scoring import one_byte_length

    frame = spark.range(1, 100_000).select(F.col("id").cast("int").alias("n"), one_byte_length(F.col("id").cast("int")).alias("kept"))
    rows = {r.n: r.kept for r in frame.collect()}
    assert all(rows[n] == n for n in range(1, 40))
    assert [rows[n] for n in (40, 41, 42, 55, 56, 59, 60, 87, 88, 96, 1000)] == [40, 40, 42, 54, 56, 56, 60, 84, 88, 96, 984]
    assert len(set(rows.values())) < 256 - 24
    assert all(0 <= n - kept <= (n - 24) / 8 for n, kept in rows.items() if n >= 40)


def test_segmentation_reads_a_text_once(spark):
    frame = spark.createDataFrame([("a " + "y" * 300,), (None,)], "t string")
    found = frame.select(F.explode_outer(tx.words_standard(F.col("t"), unicode_words=True)).alias("w"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert [r.w for r in found.collect()] == ["a", "y" * 255, "y" * 45, None]
