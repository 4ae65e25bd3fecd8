import math
import random
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.functions.edits import _restricted_distance
from corpusloom.functions.text import words_clean
from corpusloom.operators import fields as fl
from corpusloom.operators import search as se
from corpusloom.plans.ranking import display_scores, top_k, top_k_per_query

WORDS = "red blue green tiny small large gear bolt".split()


def random_docs(seed, n=40):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 15))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return random_docs(5)


@pytest.fixture(scope="module", params=["lazy", "saved"])
def index(request, spark, texts, tmp_path_factory):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, body string")
    fields = fl.fields_of_columns(docs, "doc_id", body="body")
    if request.param == "saved":
        return fl.write_index(fields, str(tmp_path_factory.mktemp("ix") / "i"))
    return fl.build_index(fields)


def bm25(texts, term):
    docs = [t.split() for t in texts]
    n, avg = len(docs), sum(map(len, docs)) / len(docs)
    df = sum(term in d for d in docs)
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return {
        i: idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / avg))
        for i, d in enumerate(docs)
        if (tf := d.count(term))
    }


def scores(hits):
    rows = [tuple(r) for r in hits.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return dict(rows)


def approx(expected):
    return pytest.approx(expected, abs=1e-9)


def test_term(index, texts):
    assert scores(se.term_search(index, "body", "Red")) == approx(bm25(texts, "red"))
    assert scores(se.term_search(index, "body", "nope")) == {}
    assert scores(se.term_search(index, "other", "red")) == {}


@pytest.mark.parametrize(
    ("must", "should", "must_not"),
    [
        ("red blue", "", ""),
        ("red", "gear bolt", "tiny"),
        ("", "gear bolt gear", "tiny small"),
        ("red", "red", ""),
        ("", "", "red"),
        ("the", "", ""),
        ("red nope", "blue", ""),
        ("red", "", "red"),
    ],
)
def test_boolean_is_set_logic(index, texts, must, should, must_not):
    must, should, must_not = (s.replace("the", "").split() for s in (must, should, must_not))
    docs = [set(t.split()) for t in texts]
    expected = {
        i: sum(bm25(texts, t).get(i, 0) for t in must + should)
        for i, d in enumerate(docs)
        if d.issuperset(must) and not d & set(must_not) and d & set(must + should)
    }
    got = se.boolean_search(index, "body", must=must, should=should, must_not=must_not)
    assert scores(got) == approx(expected)


def phrase_counts(texts, phrase):
    words = phrase.split()
    counts = {}
    for i, t in enumerate(texts):
        d = t.split()
        n = sum(d[k:k + len(words)] == words for k in range(len(d)))
        if n:
            counts[i] = n
    return counts


@pytest.mark.parametrize("phrase", ["red gear", "blue blue", "tiny red tiny", "gear nope", "bolt"])
def test_phrase_matches_brute_force(index, texts, phrase):
    counts = phrase_counts(texts, phrase)
    assert set(scores(se.phrase_search(index, "body", phrase))) == set(counts)
    if phrase == "bolt":
        assert scores(se.phrase_search(index, "body", phrase)) == approx(bm25(texts, "bolt"))


def test_multi_phrase(index, texts):
    both = set(phrase_counts(texts, "red gear")) & set(phrase_counts(texts, "blue bolt"))
    phrases = ["red gear", "blue bolt"]
    assert set(scores(se.multi_phrase_search(index, "body", phrases, "all_phrases"))) == both
    any_word = se.any_words(index, "body", "red gear blue bolt")
    assert scores(se.multi_phrase_search(index, "body", phrases)) == approx(scores(any_word))
    with pytest.raises(ValueError):
        se.multi_phrase_search(index, "body", phrases, "some")


def having(texts, keep):
    return {i: 1.0 for i, t in enumerate(texts) if any(map(keep, t.split()))}


def test_patterns_have_constant_scores(index, texts):
    assert scores(se.prefix_search(index, "body", "B")) == having(texts, lambda w: w[0] == "b")
    got = scores(se.wildcard_search(index, "body", "?e*d"))
    assert got == having(texts, lambda w: w[1] == "e" and w.endswith("d") and len(w) > 2)
    assert scores(se.wildcard_search(index, "body", r"r\*d")) == {}
    assert scores(se.regex_search(index, "body", "bl.+|bo")) == having(
        texts, lambda w: w.startswith("bl")
    )
    assert scores(se.range_search(index, "body", "blue", "gear")) == having(
        texts, lambda w: "blue" <= w <= "gear"
    )
    assert scores(se.match_all(index)) == {i: 1.0 for i in range(len(texts))}


def test_patterns_beyond_the_term_list(index, texts, monkeypatch):
    monkeypatch.setattr(se, "MAX_LISTED_TERMS", 1)
    assert scores(se.wildcard_search(index, "body", "*e*")) == having(texts, lambda w: "e" in w)


def test_fuzzy(index, texts):
    got = scores(se.fuzzy_search(index, "body", "rde"))
    assert set(got) == set(having(texts, lambda w: w == "red"))
    weight = 1 - 1 / 3
    assert got == approx({i: s * weight for i, s in bm25(texts, "red").items()})


@pytest.mark.parametrize(
    ("a", "b", "edits"),
    [("abcd", "abdc", 1), ("abcd", "abcx", 1), ("abcd", "wxyz", 4), ("ca", "abc", 3), ("", "ab", 2)],
)
def test_restricted_distance(a, b, edits):
    assert _restricted_distance(a, b) == edits


def test_disjunction(spark):
    docs = spark.createDataFrame(
        [(1, "red gear", "red"), (2, "blue gear", "green"), (3, "bolt", "red")],
        "doc_id int, a string, b string",
    )
    index = fl.build_index(fl.fields_of_columns(docs, "doc_id", a="a", b="b"))
    per_field = [scores(se.any_words(index, f, "red gear")) for f in ("a", "b")]
    got = scores(se.disjunction_search(index, ["a", "b"], "Red the gear", 5))
    expected = {}
    for doc in (1, 2, 3):
        parts = [p.get(doc, 0.0) for p in per_field]
        expected[doc] = max(parts) + 5 * (sum(parts) - max(parts))
    assert got == approx(expected)


def test_stop_words_keep_their_place(spark):
    docs = spark.createDataFrame(
        [(1, "state of the art"), (2, "state art"), (3, "state in any art")], "doc_id int, a string"
    )
    index = fl.build_index(fl.fields_of_columns(docs, "doc_id", a="a"))
    assert set(scores(se.phrase_search(index, "a", "state of the art"))) == {1, 3}
    assert scores(se.phrase_search(index, "a", "of the")) == {}
    stats = fl.field_stats(index).first()
    assert (stats.n_docs, stats.avg_len) == (3, pytest.approx(7 / 3))


def test_values_of_one_field_run_on(spark):
    fields = spark.createDataFrame(
        [(1, "author", ["Ann Lee", "Bo Ray"])], "doc_id int, field string, values array<string>"
    )
    index = fl.build_index(fields)
    assert set(scores(se.phrase_search(index, "author", "lee bo"))) == {1}
    vectors = {r.term: (r.tf, r.positions) for r in fl.term_vectors(index, "author").collect()}
    assert vectors == {"ann": (1, [1]), "lee": (1, [2]), "bo": (1, [3]), "ray": (1, [4])}


def test_batch_equals_single_queries(spark, index, texts):
    queries = spark.createDataFrame(
        [(1, "red gear"), (2, "blue the"), (3, "nope")], "query_id int, text string"
    )
    got = {(r.query_id, r.doc_id): r.score for r in se.any_words_batch(index, "body", queries).collect()}
    expected = {
        (q, doc): s
        for q, words in ((1, "red gear"), (2, "blue"))
        for doc, s in scores(se.any_words(index, "body", words)).items()
    }
    assert got == approx(expected)
    hits = se.any_words_batch(index, "body", queries)
    totals = dict(map(tuple, se.total_hits_batch(hits).collect()))
    assert totals == Counter(q for q, _ in expected)
    best = top_k_per_query(hits, 2)
    for q in (1, 2):
        order = sorted((-s, d) for (qq, d), s in expected.items() if qq == q)[:2]
        assert [r.doc_id for r in best.where(F.col("query_id") == q).orderBy("rank").collect()] == [
            d for _, d in order
        ]
    assert "WindowGroupLimit" in plan_of(best)


def test_top_k_and_totals(index, texts):
    hits = se.term_search(index, "body", "gear")
    best = top_k(hits, 3)
    order = sorted((-s, d) for d, s in bm25(texts, "gear").items())
    assert [r.doc_id for r in best.collect()] == [d for _, d in order[:3]]
    assert "TakeOrderedAndProject" in plan_of(best)
    assert se.total_hits(hits).first().n_hits == len(order)
    assert display_scores(best).first().shown == f"{-order[0][0]:.3f}"


def test_scoring_plan_has_no_join(index):
    plan = plan_of(se.boolean_search(index, "body", must="red", should="blue"))
    assert "Join" not in plan


def test_saved_index_prunes_by_term(index):
    if index.saved:
        for hits in (
            se.term_search(index, "body", "red"),
            se.wildcard_search(index, "body", "r?d"),
        ):
            assert "PushedFilters: [IsNotNull(field), IsNotNull(term), EqualTo(field,body), EqualTo(term,red)]" in plan_of(hits)


def test_search_by_name(index):
    assert set(scores(se.search(index, "Prefix", "body", "re"))) == set(
        scores(se.prefix_search(index, "body", "re"))
    )
    with pytest.raises(ValueError):
        se.search(index, "near", "body", "red")


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "index")

    def fields(*texts):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, a string")
        return fl.fields_of_columns(docs, "doc_id", a="a")

    for mode in ("append", "read"):
        with pytest.raises(FileNotFoundError):
            fl.write_index(fields("x"), path, mode)
    with pytest.raises(FileNotFoundError):
        fl.open_index(spark, path)
    with pytest.raises(ValueError):
        fl.write_index(fields().limit(0), path)
    with pytest.raises(ValueError):
        fl.write_index(fields("x"), path, "merge")

    def docs_with(term):
        return sorted(scores(se.term_search(fl.open_index(spark, path), "a", term)))

    fl.write_index(fields("one two", "two"), path)
    fl.write_index(fields("ignored"), path)
    assert docs_with("two") == [0, 1] and docs_with("ignored") == []
    fl.write_index(fields("one two", "three"), path, "append")
    assert docs_with("two") == [0, 1, 2] and docs_with("three") == [3]
    stats = fl.field_stats(fl.open_index(spark, path)).first()
    assert (stats.n_docs, stats.avg_len) == (4, 1.5)
    both = fl.build_index(fields("one two", "two", "one two", "three"))
    assert scores(se.any_words(fl.open_index(spark, path), "a", "one two")) == approx(
        scores(se.any_words(both, "a", "one two"))
    )
    fl.write_index(fields("new"), path, "overwrite")
    assert docs_with("new") == [0] and docs_with("two") == []
    assert docs_with("new") == sorted(
        scores(se.term_search(fl.write_index(fields("x"), path, "read"), "a", "new"))
    )


def test_a_delivery_is_added_once(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([("x", "one")], "doc_id string, a string")
    more = spark.createDataFrame([("y", "one")], "doc_id string, a string")
    fl.write_index(fl.fields_of_columns(docs, "doc_id", a="a"), path)
    for frame, sent in ((more, ("s", 0)), (more, ("s", 0)), (docs, ("t", 0))):
        fields = fl.fields_of_columns(frame, "doc_id", a="a")
        index = fl.write_index(fields, path, "append", delivery=sent)
    assert sorted(r.doc_id for r in se.term_search(index, "a", "one").collect()) == ["x", "x", "y"]
    assert fl.field_stats(index).first().n_docs == 3


@pytest.mark.parametrize("kind", ["string", "smallint", "decimal(5,0)", "bigint"])
def test_appended_ids_that_repeat_are_other_documents(spark, tmp_path, kind):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([("1", "red car"), ("2", "blue")], "doc_id string, a string")
    fields = fl.fields_of_columns(docs.withColumn("doc_id", F.col("doc_id").cast(kind)), "doc_id", a="a")
    fl.write_index(fields, path)
    once = se.boolean_search(fl.open_index(spark, path), "a", should="red").first().score
    index = fl.write_index(fields, path, "append")
    both = fl.build_index(fields)
    assert se.boolean_search(index, "a", must="red").count() == 2
    assert se.boolean_search(index, "a", must="red", must_not="car").count() == 0
    assert se.phrase_search(index, "a", "red car").count() == 2
    assert se.prefix_search(index, "a", "r").count() == 2
    assert se.match_all(index).count() == 4 == fl.field_stats(index).first().n_docs
    found = se.boolean_search(index, "a", should="red").collect()
    assert len(found) == 2 and all(r.score < 2 * once for r in found)
    assert se.match_all(both).count() == 2


def test_an_overwrite_that_breaks_off_leaves_the_old_index(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(0, "old")], "doc_id bigint, a string")
    fl.write_index(fl.fields_of_columns(docs, "doc_id", a="a"), path)
    (tmp_path / "index" / "lengths" / "version=1").mkdir()
    assert se.term_search(fl.open_index(spark, path), "a", "old").count() == 1


def test_regex_case(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "123")], "doc_id int, a string")
    index = fl.build_index(fl.fields_of_columns(docs, "doc_id", a="a"))
    for pattern, found in {r"\D+": [1], r"\d+": [2], r"ABC": [1], r"\QABC\E": [1], r"\P{L}+": [2], r"[A-C]+": [1],
                           r"(?<Name>A)BC": [1], r"\W*": [], r"(A|B|C)+": [1]}.items():
        assert sorted(scores(se.regex_search(index, "a", pattern))) == found, pattern


def test_fuzzy_keeps_every_term(spark, monkeypatch):
    letters = "bcdfghjklmnpqrstvwxz"
    words = [f"a{x}{y}de" for x in letters for y in letters]
    docs = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "doc_id int, a string")
    index = fl.build_index(fl.fields_of_columns(docs, "doc_id", a="a"))
    listed = scores(se.fuzzy_search(index, "a", "abcde"))
    assert len(listed) == 400
    monkeypatch.setattr(se, "MAX_LISTED_TERMS", 10)
    assert scores(se.fuzzy_search(index, "a", "abcde")) == approx(listed)
    assert se.similar_terms(index.vocabulary, "abcde", max_expansions=7).count() == 7


def test_unfinished_batches_are_not_read(spark, tmp_path):
    path = tmp_path / "index"
    docs = spark.createDataFrame([(0, "one two")], "doc_id bigint, a string")
    fields = fl.fields_of_columns(docs, "doc_id", a="a")
    index = fl.write_index(fields, str(path))
    for table in ("postings", "vocabulary", "docs"):
        getattr(index, table).drop("batch").write.parquet(f"{path}/{table}/batch=1")
    index = fl.open_index(spark, str(path))
    assert list(scores(se.term_search(index, "a", "one"))) == [0]
    index = fl.write_index(fields, str(path), "append")
    assert sorted(scores(se.term_search(index, "a", "one"))) == [0, 1]


def test_a_field_without_words(spark):
    docs = spark.createDataFrame([(1, "the", "x")], "doc_id int, a string, b string")
    index = fl.build_index(fl.fields_of_columns(docs, "doc_id", a="a", b="b"))
    assert scores(se.term_search(index, "a", "the")) == {}
    stats = {r.field: (r.n_docs, r.avg_len) for r in fl.field_stats(index).collect()}
    assert stats == {"a": (0, None), "b": (1, 1.0)}


def test_other_analyzers(spark):
    docs = spark.createDataFrame([(1, "well-known don't")], "doc_id int, a string")
    index = fl.build_index(fl.fields_of_columns(docs, "doc_id", a="a"), analyzer=words_clean)
    assert {r.term for r in index.vocabulary.collect()} == {"wellknown", "dont"}
