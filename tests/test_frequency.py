import random
from collections import Counter

from pyspark.sql import functions as F

from corpusloom.functions.text import words_alpha
from corpusloom.operators import frequency as fq
from corpusloom.operators import tables
from corpusloom.operators.postings import position_lines
from corpusloom.plans.ranking import place_of
from corpusloom.sources.corpus import read_corpus, read_corpus_lines

from conftest import plan_of


def corpus(tmp_path):
    (tmp_path / "a.txt").write_bytes(b"The cat. The cat sat")
    (tmp_path / "b.txt").write_bytes("the café don't".encode("latin-1"))
    (tmp_path / "c.TXT").write_bytes(b"never read")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.txt").write_bytes(b"nor this")
    return str(tmp_path)


def test_corpus_scan(spark, tmp_path):
    (tmp_path / "crlf %20+.txt").write_bytes(b"one\r\ntwo\rthree")
    path = corpus(tmp_path)
    docs = {r.doc_id: r.text for r in read_corpus(spark, path, ".txt").collect()}
    assert docs == {
        "a.txt": "The cat. The cat sat",
        "b.txt": "the café don't",
        "crlf %20+.txt": "one\ntwo\nthree",
    }
    assert "c.TXT" in {r.doc_id for r in read_corpus(spark, path).collect()}


def test_every_byte_decodes(spark, tmp_path):
    (tmp_path / "x").write_bytes(bytes(b for b in range(256) if b != 13))
    text = read_corpus(spark, str(tmp_path)).first().text
    assert [ord(c) for c in text] == [b for b in range(256) if b != 13]


def test_counts_and_ranks(spark, tmp_path):
    docs = read_corpus(spark, corpus(tmp_path), ".txt")
    counts = fq.counts_from_ngrams(fq.ngrams(docs, 1))
    by_count = [(r.ngram, r.n) for r in fq.rank_by_count(counts).collect()]
    assert by_count == [("the", 3), ("cat", 1), ("sat", 1), ("café", 1)]
    alphabetical = [r.ngram for r in fq.rank_alphabetical(counts).collect()]
    assert alphabetical == ["café", "cat", "sat", "the"]
    assert dict(fq.ngram_counts(docs, 2).collect()) == {
        "the the": 1, "the cat": 1, "cat sat": 1, "the café": 1,
    }


def test_letters_over_raw_text(spark, tmp_path):
    letters = dict(fq.letter_counts(read_corpus(spark, corpus(tmp_path), ".txt")).collect())
    expected = dict.fromkeys("abcdefghijklmnopqrstuvwxyz", 0)
    expected |= dict(t=7, h=3, e=3, c=3, a=4, s=1, f=1, d=1, o=1, n=1)
    assert {k: v for k, v in letters.items()} == expected


def test_letters_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert {r.n for r in fq.letter_counts(empty).collect()} == {0}


def test_ties_keep_first_occurrence(docs_of):
    docs = docs_of("b a", "c a b")
    ranked = fq.rank_by_count(fq.counts_from_ngrams(fq.ngrams(docs, 1)))
    assert [r.ngram for r in ranked.collect()] == ["b", "a", "c"]


def test_merge_is_a_multiset_sum(docs_of):
    one, two = docs_of("a b a"), docs_of("b c")
    merged = fq.merge_counts(fq.ngram_counts(one, 1), fq.ngram_counts(two, 1))
    assert dict(merged.collect()) == {"a": 2, "b": 2, "c": 1}


def test_frequency_files(spark, tmp_path):
    docs = read_corpus(spark, corpus(tmp_path), ".txt")
    out = tmp_path / "out"
    tables.write_frequency_tables(docs, str(out))

    def lines(name):
        parts = sorted(p for p in (out / name).iterdir() if p.name.startswith("part-"))
        return b"".join(p.read_bytes() for p in parts).decode()

    assert lines("uni") == "the,3\r\ncat,1\r\nsat,1\r\ncafé,1\r\n"
    assert lines("uni_alpha") == "café,1\r\ncat,1\r\nsat,1\r\nthe,3\r\n"
    assert lines("bi_dat").startswith("the the,1\r\nthe cat,1\r\n")
    assert lines("tii_alpha") == "the cat sat,1\r\nthe the cat,1\r\n"
    assert lines("tri_dat") == "the the cat,1\r\nthe cat sat,1\r\n"
    assert lines("letters").splitlines()[0] == "a,4"
    assert len(lines("letters").splitlines()) == 26


def test_long_files_are_numbered_across_lines_and_splits(spark, tmp_path):
    rng = random.Random(3)
    text = "\n".join(
        " ".join(rng.choice("abcd") for _ in range(rng.choice([0, 1, 1, 2, 5]))) for _ in range(400)
    )
    (tmp_path / "long").write_text(text)
    (tmp_path / "short").write_text("a\n\nb c")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        lines = read_corpus_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        tokens = position_lines(lines, words_alpha, lines_per_block=3)
        got = sorted((r.doc_id, r.pos, r.term) for r in tokens.collect())
        grams = fq.ngrams_of_positions(tokens, 3).groupBy("ngram").count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    words = {"long": text.split(), "short": ["a", "b", "c"]}
    assert got == sorted((d, i + 1, w) for d, ws in words.items() for i, w in enumerate(ws))
    expected = Counter(
        " ".join(ws[i:i + 3]) for ws in words.values() for i in range(len(ws) - 2)
    )
    assert dict(map(tuple, grams)) == expected


def test_position_ngrams_cross_block_borders(spark, monkeypatch):
    tokens = spark.createDataFrame(
        [(1, i + 1, w) for i, w in enumerate("abcdefg")], "doc_id int, pos int, term string"
    )
    monkeypatch.setattr("corpusloom.plans.blocks.with_lookahead.__defaults__", (2, "pos"))
    got = sorted(r.ngram for r in fq.ngrams_of_positions(tokens, 3).collect())
    assert got == ["a b c", "b c d", "c d e", "d e f", "e f g"]


def test_first_occurrences_of_any_id(spark):
    docs = spark.createDataFrame(
        [(2**63 - 1, "a f"), (7, "b a g"), (-(2**63), "c x b"), (2**31, "d"), (2**31 - 1, "e d"), (None, "n")], "doc_id bigint, text string"
    )
    counts = fq.counts_from_ngrams(fq.ngrams(docs, 1))
    got = [r.ngram for r in fq.rank_by_count(counts).collect()]
    assert got == ["b", "a", "d", "n", "c", "x", "g", "e", "f"]
    placed = {r.ngram: (r.d, r.p) for r in counts.select("ngram", *[c.alias(n) for c, n in zip(place_of(F.col("first")), "dp")]).collect()}
    assert placed["b"][0] == -(2**63) and placed["a"] == (7, 2) and placed["d"] == (2**31 - 1, 2) and placed["f"] == (2**63 - 1, 2)


def test_occurrences_are_counted_without_decimals(spark, docs_of):
    counts = fq.counts_from_ngrams(fq.ngrams(docs_of("a b"), 1))
    assert "min(CASE WHEN" in counts._jdf.queryExecution().optimizedPlan().toString()
    assert "_near" in plan_of(fq.rank_by_count(counts))


def test_each_size_is_sorted_alone(docs_of, tmp_path):
    tables.write_frequency_tables(docs_of("b a b", "a"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out" / "counts").iterdir() if p.is_dir()) == ["size=1", "size=2", "size=3"]
    empty = tables.write_frequency_tables(docs_of("1").limit(0), str(tmp_path / "none"))
    assert empty is None and (tmp_path / "none" / "tri_dat").is_dir()


def test_frequency_files_can_be_compressed_and_leave_no_shuffle_files(spark, docs_of, tmp_path):
    def shuffled():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(k).getName() for k in range(held.size()) if held.apply(k).getName().startswith("shuffle_")}

    before = shuffled()
    tables.write_frequency_tables(docs_of("b a b", "a"), str(tmp_path), compression="gzip")
    assert not shuffled() - before
    assert not list(tmp_path.glob("*/part-*.csv")) and list(tmp_path.glob("letters/part-*.csv.gz"))
    read = spark.read.schema("ngram string, n bigint").option("lineSep", "\r\n")
    assert [tuple(r) for r in read.csv(str(tmp_path / "uni")).collect()] == [("b", 2), ("a", 2)]
    assert {tuple(r) for r in read.csv(str(tmp_path / "bii_alpha")).collect()} == {("a b", 1), ("b a", 1)}
