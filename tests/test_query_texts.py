"""Query texts, phrases with slop and vocabulary lookups against plain Python."""

import math
import random
import re

import pytest
from corpusloom.functions.alignment import phrase_frequency
from corpusloom.functions.edits import _restricted_distance
from corpusloom.functions.patterns import regex_grams, wildcard_grams
from corpusloom.functions.query_text import read_line, read_query
from corpusloom.operators import fields as fl
from corpusloom.operators import lookup as lk
from corpusloom.operators import query_texts as qt
from corpusloom.operators import search as se
from pyspark.sql import functions as F

from conftest import plan_of

approx = lambda scores: pytest.approx(scores, abs=1e-9)


def shape(text):
    """A query text's tree as nested tuples."""
    read = read_query(text)
    if read["error"]:
        return None

    def of(n):
        node = read["nodes"][n]
        if node["leaf"] is not None:
            leaf = read["leaves"][node["leaf"]]
            found = (leaf["kind"], leaf["text"] or (leaf["low"], leaf["high"]), leaf["number"], leaf["field"])
        else:
            found = tuple((sign, of(c)) for sign, k in (("+", "must"), ("", "should"), ("-", "must_not")) for c in node[k])
        return found if node["boost"] == 1 else (found, node["boost"])

    return of(len(read["nodes"]) - 1)


def w(text, kind="word", number=0.0, field=None):
    return kind, text, number, field


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("+recent +years -have", (("+", w("recent")), ("+", w("years")), ("-", w("have")))),
        ("(recent years)", (("", (("", w("recent")), ("", w("years")))),)),
        ("(a b) and (c)", (("", (("", w("a")), ("", w("b")))), ("", w("and")), ("", (("", w("c")),)))),
        ('"a b"~3 !c', (("", w("a b", "phrase", 3.0)), ("-", w("c")))),
        ("a && b || c", (("+", w("a")), ("+", w("b")), ("", w("c")))),
        (r"wi-fi a\*b x* y?z~ q~1", (("", w("wi-fi")), ("", w("a*b")), ("", w("x*", "pattern")), ("", w("y?z", "fuzzy", 2.0)), ("", w("q", "fuzzy", 1.0)))),
        ("t:(a [b to *])^2 c", (("", ((("", w("a", field="t")), ("", w(("b", None), "range", field="t"))), 2.0)), ("", w("c")))),
        ("+(a -(b +c))", (("+", (("", w("a")), ("-", (("+", w("c")), ("", w("b")))))),)),
        ("(a", None), ("a)", None), ("()", None), ("", None), ("a +", None), ('"a', None), (None, None),
    ],
)
def test_reading(text, expected):
    assert shape(text) == expected


def test_lines():
    assert read_line("matchall") == ("matchall", [])
    assert read_line("Term Abstract Have") == ("term", ["Abstract", "have"])
    assert read_line("termrange year 2015,2017") == ("termrange", ["year", "2015", "2017"])
    assert read_line("disjunction 5; abstract title; Some words ") == ("disjunction", [["abstract", "title"], "some words", 5.0])
    for line in ("term", "term field", "termrange year 2015", "disjunction x; a b; c", "disjunction 5; a b"):
        with pytest.raises(ValueError):
            read_line(line)


DOCS = [
    "Recent years have seen distributed computing", "years recent", "computing is not distributed in recent times",
    "the years", "have", "", None, "red blue green red green blue", "blue red", "green x x blue x red", "thin thinly thing",
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id int, text string")
    path = str(tmp_path_factory.mktemp("index"))
    return fl.write_index(fl.fields_of_columns(docs, "doc_id", text="text", again="text"), path)


def hits(df):
    return {r.doc_id: r.score for r in df.collect()}


def test_texts_against_the_single_searches(index):
    def found(text):
        return hits(qt.query_search(index, "text", text))

    assert found("+recent +years -have") == approx(hits(se.boolean_search(index, "text", "recent years", (), "have")))
    assert found("(recent years)") == approx(hits(se.any_words(index, "text", "recent years")))
    assert found('"recent years"') == approx(hits(se.phrase_search(index, "text", "recent years")))
    assert found("(distributed computing) and (recent years)") == approx(
        hits(se.any_words(index, "text", "distributed computing recent years"))
    )
    assert found("-recent -years") == {} and found("the") == {} and found("+the -is") == {}
    assert found("+the years") == approx(hits(se.any_words(index, "text", "years")))
    assert found("thin*") == {10: 1.0} and found("thi? OR [thin TO thing]") == {10: 2.0}
    assert found("[thin to thing]") == hits(se.range_search(index, "text", "thin", "thing"))
    assert found("thinn~1") == approx(hits(se.fuzzy_search(index, "text", "thinn", max_edits=1)))
    assert found("again:recent") == approx(hits(se.term_search(index, "again", "recent")))
    both = found("recent^3 thin*^2")
    assert both[10] == approx(2.0) and both[1] == approx(3 * found("recent")[1])
    nested = found('+(computing "recent years") -(not times) red')
    assert set(nested) == {0}
    assert found('+(computing "recent years") -(seen times) red') == {}
    with pytest.raises(ValueError):
        qt.query_search(index, "text", "(a")


def test_tables_of_texts(spark, index):
    texts = ["red", '"red blue"', "(", None, "", "zzz", "+red +zzz", "red", "th* -recent"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string").selectExpr("*", "1 leaf", "2 doc_id")
    found = qt.query_hits(index, "text", queries).collect()
    assert {(r.query_id, r.doc_id) for r in found} == {(0, 7), (0, 8), (0, 9), (1, 7), (7, 7), (7, 8), (7, 9), (8, 10)}
    assert {r.query_id for r in qt.unreadable(queries).collect()} == {2, 3, 4}
    assert qt.query_hits(index, "text", queries.limit(0)).count() == 0


def test_lines_reach_every_search(index):
    assert set(hits(qt.search_line(index, 'phrase text "recent years"'))) == {0}
    assert set(hits(qt.search_line(index, "multiphrase text (distributed computing) and (recent years)"))) == {0, 1, 2, 3}
    assert set(hits(qt.search_line(index, "boolean text +recent -have"))) == {1, 2}
    assert hits(qt.search_line(index, "disjunction 5; text again; recent")) == approx(
        hits(se.disjunction_search(index, ["text", "again"], "recent", 5))
    )
    assert len(hits(qt.search_line(index, "matchall"))) == len(DOCS)
    with pytest.raises(ValueError):
        qt.search_line(index, "nearest text recent")


def plain_frequency(words, slop):
    """The definition, start by start; ``words`` are (offset, positions)."""
    if len(words) == 1:
        return float(len(words[0][1]))
    events = sorted((p - o, slot, p) for slot, (o, positions) in enumerate(words) for p in positions)
    total = 0.0
    for n, (at, slot, pos) in enumerate(events):
        after = events[n + 1 :]
        others = [next((e for e in after if e[1] == k), None) for k in range(len(words)) if k != slot]
        if None in others or any(e[2] == pos for e in others):
            continue
        if any(e[1] == slot and e[0] <= min(o[0] for o in others) for e in after):
            continue
        moves = max(e[0] for e in others) - at
        total += 1 / (1 + moves) if moves <= slop else 0
    return total


def test_frequencies(spark):
    pick = random.Random(6)
    rows = []
    for number in range(400):
        n = pick.randint(1, 4)
        offsets = sorted(pick.sample(range(6), n))
        size = pick.choice([6, 15, 60])
        rows.append((number, [(o, sorted(pick.sample(range(1, size + 1), pick.randint(1, min(size, 8))))) for o in offsets], pick.randint(0, 6)))
    frame = spark.createDataFrame(
        [(n, [(s, o, p) for s, (o, p) in enumerate(ws)], slop) for n, ws, slop in rows],
        "n int, words array<struct<slot:int,offset:int,positions:array<int>>>, slop int",
    )
    found = {r.n: r.f for r in frame.select("n", phrase_frequency(F.col("words"), F.col("slop")).alias("f")).collect()}
    assert found == pytest.approx({n: plain_frequency(ws, slop) for n, ws, slop in rows})
    assert sum(map(bool, found.values())) > 100


def test_slop_in_documents(spark, index):
    queries = [(0, "red blue", 0), (1, "red blue", 1), (2, "red blue", 2), (3, "red blue", 4), (4, "blue red", 0), (5, "the years", 0)]
    frame = spark.createDataFrame(queries, "query_id int, text string, slop int")
    found = {(r.query_id, r.doc_id): r.score for r in qt.phrase_batch(index, "text", frame).collect()}
    assert set(found) == {(0, 7), (1, 7), (2, 7), (2, 8), (3, 7), (3, 8), (3, 9), (4, 8)} | {(5, d) for d in (0, 1, 3)}
    assert {d: s for (q, d), s in found.items() if q == 0} == approx(hits(se.phrase_search(index, "text", "red blue")))


WORDS = ["", "a", "ab", "ba", "abc", "thing", "thin", "things", "tihng", "über", "ubre", "x" * 23, "x" * 24, "x" * 25, "x" * 27, "y" + "x" * 24]


def vocabulary_index(spark, words):
    vocabulary = spark.createDataFrame([("f", t, 1) for t in sorted(set(words))], "field string, term string, df bigint")
    return fl.FieldIndex(docs=None, postings=None, vocabulary=vocabulary, lengths=None, saved=True)


def test_edits_against_all_pairs(spark, tmp_path):
    pick = random.Random(2)
    words = WORDS + ["".join(pick.choices("abx", k=pick.randint(1, 6))) for _ in range(120)]
    for _ in range(60):
        long = "".join(pick.choices("abcd", k=pick.randint(22, 40)))
        words.append(long)
        for _ in range(2):
            at = pick.randrange(len(long) - 1)
            long = pick.choice([long[:at] + long[at + 1 :], long[:at] + "q" + long[at:], long[:at] + long[at + 1] + long[at] + long[at + 2 :]])
            words.append(long)
    index = vocabulary_index(spark, words)
    lookup = lk.write_lookup(index, str(tmp_path / "lookup"))
    asked = spark.createDataFrame([(t, "f", t, 1 if len(t) % 2 else 2) for t in sorted(set(words))], "key string, field string, word string, max_edits int")
    expected = set()
    for q in set(words):
        for t in set(words):
            if abs(len(q) - len(t)) <= 2:
                edits = _restricted_distance(t, q)
                if edits <= (1 if len(q) % 2 else 2) and edits < min(len(t), len(q)):
                    expected.add((q, t, edits))
    found = lk.terms_within(index, asked, lookup)
    assert {(r.key, r.term, r.edits) for r in found.collect()} == expected
    assert {(r.key, r.term, r.edits) for r in lk.terms_within(index, asked).collect()} == expected


PATTERNS = ["thin*", "*in*", "*", "?", "??", "*ng", "t?i*g", "a*", "*a", "q*", "", r"a\*", "ü*", "*x?x*"]
REGEXES = ["thin.*", ".*in.*", ".*", "[ab]+", "a|ab", "(thin|thing)s?", "thi(n|m)g", "th?i?ng*", "x{24}", "x{2,}y?", r"\w+ng", "THING", r"t\p{L}in", "yx+", "a+b?c?", "[^a]b"]


def test_patterns_against_all_terms(spark, tmp_path):
    words = WORDS + ["a*", "baa", "xin", "tin"]
    index = vocabulary_index(spark, words)
    lookup = lk.write_lookup(index, str(tmp_path / "lookup"))
    for syntax, patterns in (("wildcard", PATTERNS), ("regex", REGEXES)):
        asked = spark.createDataFrame([(p, "f", p) for p in patterns], "key string, field string, pattern string")
        expected = set()
        for p in patterns:
            if syntax == "regex":
                plain = p.lower().replace(r"\p{l}", r"[^\W\d_]")
            else:
                plain = "".join(re.escape(e[1]) if e[0] == "\\" else {"*": ".*", "?": "."}.get(e, re.escape(e)) for e in re.findall(r"\\.|.", p))
            expected |= {(p, t) for t in set(words) if re.fullmatch(plain, t, re.DOTALL)}
        for way in (lookup, None):
            found = lk.terms_of_patterns(index, asked, way, syntax)
            assert {(r.key, r.term) for r in found.collect()} == expected, syntax


def test_required_runs():
    assert wildcard_grams("*") == [] and wildcard_grams("ab*") == ["\x02ab"]
    assert regex_grams("a|bcd") == [] and regex_grams("(?i)abc") == [] and regex_grams("[a-c]+ing") == ["ing", "ng\x03"]


def test_batches_do_not_scan_the_vocabulary(spark, tmp_path):
    words = ["thing", "thin", "sing", "song", "wing"] * 20
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "doc_id int, text string")
    index = fl.write_index(fl.fields_of_columns(docs, "doc_id", text="text"), str(tmp_path / "index"))
    lookup = lk.write_lookup(index, str(tmp_path / "lookup"))
    asked = spark.createDataFrame([("1", "text", "thang", 2), ("2", "text", "*ing", 0)], "key string, field string, word string, max_edits int")
    for found in (
        lk.terms_within(index, asked, lookup),
        lk.terms_of_patterns(index, asked.withColumnRenamed("word", "pattern").where("key = '2'"), lookup),
    ):
        assert found.count() > 1
        assert "/index/vocabulary" not in plan_of(found) and "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_scores_are_finite(index):
    assert all(math.isfinite(s) for s in hits(qt.query_search(index, "text", 'red "blue green"~9 th* -zzz')).values())


def test_lookup_rows_grow_with_the_length_of_terms(spark):
    pick = random.Random(5)
    for size in range(8, 25):
        term = "".join(pick.choices("abcdefgh", k=size))
        one = spark.range(1).select(lk.term_variants(F.lit(term)).alias("keys"))
        assert len(one.first().keys) <= size + 2


def test_half_keys_meet_within_two_edits(spark, tmp_path):
    pick = random.Random(6)
    words = []
    for _ in range(80):
        word = "".join(pick.choices("abcde", k=pick.randint(6, 13)))
        words.append(word)
        for _ in range(2):
            at = pick.randrange(len(word) - 1)
            word = pick.choice([word[:at] + word[at + 1 :], word[:at] + "q" + word[at + 1 :], word[:at] + "q" + word[at:], word[:at] + word[at + 1] + word[at] + word[at + 2 :]])
            words.append(word)
    lookup = lk.write_lookup(vocabulary_index(spark, words), str(tmp_path / "lookup"))
    asked = spark.createDataFrame([(w, "f", w, 2) for w in sorted(set(words))], "key string, field string, word string, max_edits int")
    expected = {(q, t) for q in set(words) for t in set(words) if _restricted_distance(t, q) <= 2}
    assert {(r.key, r.term) for r in lk.terms_within(vocabulary_index(spark, words), asked, lookup).collect()} == expected


def test_phrases_are_lined_up_once(spark, index):
    queries = spark.createDataFrame([(1, '"red blue"~2')], "query_id int, text string")
    plan = qt.query_hits(index, "text", queries)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(array_sort(") == 1


def test_fuzzy_terms_are_found_once(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "thin thing"), (2, "think them"), (3, "song")], "doc_id int, text string")
    index = fl.write_index(fl.fields_of_columns(docs, "doc_id", text="text"), str(tmp_path / "index"))
    listed = sorted(map(tuple, se.fuzzy_search(index, "text", "thing").collect()))
    monkeypatch.setattr(se, "MAX_LISTED_TERMS", 0)
    joined = se.fuzzy_search(index, "text", "thing")
    assert "levenshtein" not in plan_of(joined)
    assert [(d, round(s, 9)) for d, s in sorted(map(tuple, joined.collect()))] == [(d, round(s, 9)) for d, s in listed]
