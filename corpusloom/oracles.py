"""DuckDB SQL with the same results as :mod:`corpusloom.queries`."""

from __future__ import annotations

# --- fixed values, written out here too so that a wrong entry in the package shows ----------
B, K1 = 0.75, 1.2
CLEAN_DELETED = '@#$%^&?<>*()\t=-;\\]["\''
CLEAN_SPACED = '\n\r!.,:'
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their "
    "then there these they this to was will with "
).split()
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news":
    "news", "inning": "inning", "innings": "inning", "outing": "outing", "outings":
    "outing", "canning": "canning", "cannings": "canning", "howe": "howe", "proceed":
    "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization":
    "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
    "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize "
).split()
# ------------------------------------------------------------------------------------------

_WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]+"
)
_ALPHA = rf"""alpha AS (
  SELECT doc_id, lang, list_filter(string_split_regex(lower(text), '{_WS}'),
                                   lambda x: regexp_full_match(x, '\p{{L}}+')) AS w
  FROM documents)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _blanks() -> str:
    spaced = " || ".join(f"chr({ord(c)})" for c in CLEAN_SPACED)
    removed = " || ".join(f"chr({ord(c)})" for c in CLEAN_DELETED)
    return f"translate(lower(text), {spaced} || {removed}, repeat(' ', {len(CLEAN_SPACED)}))"


def _clean(table: str = "documents", key: str = "doc_id") -> str:
    return (
        f"SELECT {key}, list_filter(string_split({_blanks()}, ' '), lambda x: x <> '') AS w "
        f"FROM {table}"
    )


_CLEAN_TOKENS = f"""clean AS ({_clean()}),
tok AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM clean)"""


def _grams(n: int) -> str:
    """CTEs ending in ``g(doc_id, lang, pos, ngram)``."""
    parts = ["term"] + [f"lead(term, {k}) OVER d" for k in range(1, n)]
    return f"""{_ALPHA},
a{n} AS (SELECT doc_id, lang, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM alpha),
g AS (SELECT * FROM (SELECT doc_id, lang, pos, {" || ' ' || ".join(parts)} AS ngram FROM a{n}
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)) WHERE ngram IS NOT NULL)"""


def _ngram_counts(n: int, extra: str = "") -> str:
    return f"""WITH {_grams(n)}
SELECT {extra} ngram, count(*) AS n FROM g GROUP BY {extra} ngram"""


def _ranked(n: int, limit: str = "") -> str:
    return f"""WITH {_grams(n)},
c AS (SELECT ngram, count(*) AS n, min(struct_pack(d := doc_id, p := pos)) AS f FROM g GROUP BY ngram)
SELECT ngram, n, f.d AS first_doc, CAST(f.p AS INTEGER) AS first_pos FROM c
ORDER BY n DESC, f.d, f.p {limit}"""


# --- stemming: regular expressions over the vocabulary; a consonant y is written Y ----------
def _cases(rules: dict[str, str]) -> str:
    pairs = ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in rules.items())
    return f"MAP {{{pairs}}}"


def _stem_ctes(words: str) -> str:
    """CTEs ending in ``stems(term, stem)`` for a query ``words`` with a column ``term``."""
    some = "'[aeiouy][^aeiouy]'"
    two = "'(?s)[aeiouy][^aeiouy].*[aeiouy][^aeiouy]'"
    short = (
        "(regexp_matches({0}, '[^aeiouy][aeiouy][^aeiouywxY]$') "
        "OR regexp_full_match({0}, '[aeiouy][^aeiouy]'))"
    )

    def suffix(rules: dict[str, str]) -> str:
        return f"regexp_extract(t, '(?s)^(.*?)({'|'.join(rules)})$', 2)"

    return rf"""
s0 AS (SELECT DISTINCT term, regexp_replace(regexp_replace(regexp_replace(term, '^y', 'Y'),
        '([aeiou])y', '\1Y', 'g'), 'yy', 'yY', 'g') AS t FROM ({words})
       WHERE length(term) > 2 AND term NOT IN ({', '.join(map(_quoted, IRREGULAR))})),
s1 AS (SELECT term, CASE
    WHEN t LIKE '%ies' THEN CASE WHEN length(t) = 4 THEN t[:-2] ELSE t[:-3] END
    WHEN t LIKE '%sses' THEN t[:-3]
    WHEN t LIKE '%s' AND t NOT LIKE '%ss' THEN t[:-2] ELSE t END AS t FROM s0),
s1b AS (SELECT term, t, CASE WHEN t LIKE '%ed' THEN t[:-3] WHEN t LIKE '%ing' THEN t[:-4] END AS r FROM s1),
s1c AS (SELECT term, CASE
    WHEN t LIKE '%ied' THEN CASE WHEN length(t) = 4 THEN t[:-2] ELSE t[:-3] END
    WHEN t LIKE '%eed' THEN CASE WHEN regexp_matches(t[:-4], {some}) THEN t[:-2] ELSE t END
    WHEN r IS NULL OR NOT regexp_matches(r, '[aeiouy]') THEN t
    WHEN regexp_matches(r, '(at|bl|iz)$') THEN r || 'e'
    WHEN length(r) > 1 AND lower(r[-1]) = lower(r[-2:-2]) AND regexp_matches(r, '[^aeiouy]$')
      THEN CASE WHEN r[-1] IN ('l', 's', 'z') THEN r ELSE r[:-2] END
    WHEN regexp_matches(r, {some}) AND NOT regexp_matches(r, {two}) AND {short.format('r')} THEN r || 'e'
    ELSE r END AS t FROM s1b),
s1d AS (SELECT term, CASE WHEN t LIKE '%y' AND length(t) > 2 THEN t[:-2] || 'i' ELSE t END AS t FROM s1c),
s2a AS (SELECT term, CASE WHEN t LIKE '%alli' AND regexp_matches(t[:-5], {some})
    THEN t[:-3] ELSE t END AS t FROM s1d),
s2b AS (SELECT term, t, {suffix(STEP_2)} AS x FROM s2a),
s2 AS (SELECT term, CASE WHEN x = '' THEN t
    WHEN regexp_matches(t[:length(t) - length(x)] || CASE WHEN x = 'logi' THEN 'l' ELSE '' END, {some})
    THEN t[:length(t) - length(x)] || {_cases(STEP_2)}[x] ELSE t END AS t FROM s2b),
s3b AS (SELECT term, t, {suffix(STEP_3)} AS x FROM s2),
s3 AS (SELECT term, CASE WHEN x = '' THEN t WHEN regexp_matches(t[:length(t) - length(x)], {some})
    THEN t[:length(t) - length(x)] || {_cases(STEP_3)}[x] ELSE t END AS t FROM s3b),
s4b AS (SELECT term, t, {suffix(STEP_4)} AS x FROM s3),
s4 AS (SELECT term, CASE WHEN x <> '' AND regexp_matches(t[:length(t) - length(x)], {two})
    AND (x <> 'ion' OR regexp_matches(t[:length(t) - 3], '[st]$'))
    THEN t[:length(t) - length(x)] ELSE t END AS t FROM s4b),
s5 AS (SELECT term, CASE WHEN t LIKE '%e' AND (regexp_matches(t[:-2], {two})
    OR (regexp_matches(t[:-2], {some}) AND NOT {short.format('t[:-2]')})) THEN t[:-2] ELSE t END AS t FROM s4),
s6 AS (SELECT term, CASE WHEN t LIKE '%ll' AND regexp_matches(t[:-2], {two}) THEN t[:-2] ELSE t END AS t FROM s5),
stems AS (SELECT term, lower(t) AS stem FROM s6
  UNION ALL SELECT DISTINCT term, COALESCE({_cases(IRREGULAR)}[term], term) FROM ({words})
  WHERE length(term) <= 2 OR term IN ({', '.join(map(_quoted, IRREGULAR))}))"""


_STEMS = f"{_CLEAN_TOKENS}, {_stem_ctes('SELECT term FROM tok')}"


# --- proximity -----------------------------------------------------------------------------
def _near(first: str, second: str, dist: int, ordered: bool = False) -> str:
    either = "" if ordered else f" OR (a.term = {_quoted(second)} AND b.term = {_quoted(first)})"
    return f"""WITH {_CLEAN_TOKENS}
SELECT DISTINCT a.doc_id, CAST(a.pos AS INTEGER) AS pos FROM tok a JOIN tok b
ON a.doc_id = b.doc_id AND b.pos > a.pos AND b.pos <= a.pos + {dist}
WHERE (a.term = {_quoted(first)} AND b.term = {_quoted(second)}){either}"""


_PAIRS = f"""q AS (SELECT item_id || '-' || CAST(k - 1 AS VARCHAR) AS query_id, w[k] AS w1,
  CAST(item_id % 6 AS INTEGER) AS max_dist, w[k + 2] AS w2
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 1)) AS k FROM ({_clean('benchmark', 'item_id')})))"""


def _near_tokens(tokens: str) -> str:
    """Tokens with each of the five that follow."""
    return f"""nt AS (SELECT a.doc_id, a.pos, a.term AS t1, b.term AS t2, b.pos - a.pos AS gap
  FROM (SELECT *, unnest(range(1, 6)) AS k FROM {tokens}) a JOIN {tokens} b ON b.doc_id = a.doc_id AND b.pos = a.pos + a.k)"""


_MATCHES_PER_QUERY = """SELECT query_id, count(*) AS n, count(DISTINCT doc_id) AS n_docs,
  CAST(sum(doc_id * 31 + pos) AS BIGINT) AS places
FROM (SELECT DISTINCT query_id, doc_id, pos FROM (
  SELECT query_id, doc_id, pos FROM q JOIN nt ON t1 = w1 AND t2 = w2 WHERE gap <= max_dist
  UNION ALL SELECT query_id, doc_id, pos FROM q JOIN nt ON t1 = w2 AND t2 = w1 WHERE gap <= max_dist))
GROUP BY query_id"""


# --- fielded index and scores ----------------------------------------------------------------
_STOP = ", ".join(map(_quoted, STOP_WORDS))


def _index(source: str) -> str:
    """CTEs over ``src(doc_id, field, v)``: words, postings, lengths, statistics."""
    return rf"""src AS ({source}),
wrd AS (SELECT doc_id, field, regexp_extract_all(lower(v), '[\p{{L}}\p{{N}}]+') AS w FROM src),
ft AS (SELECT * FROM (SELECT doc_id, field, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM wrd)
       WHERE term NOT IN ({_STOP})),
post AS (SELECT field, term, doc_id, count(*) AS tf FROM ft GROUP BY ALL),
len AS (SELECT field, doc_id, count(*) AS dl FROM ft GROUP BY ALL),
st AS (SELECT field, count(*) AS n_docs, sum(dl) / count(*) AS avgdl FROM len GROUP BY field),
dfs AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL)"""


_TEXT = _index("SELECT doc_id, 'text' AS field, text AS v FROM documents")
_PART = _index(
    "SELECT p_partkey AS doc_id, 'name' AS field, p_name AS v FROM part "
    "UNION ALL SELECT p_partkey, 'type', p_type FROM part"
)
_ORDER_TITLES = _index(
    "SELECT o_orderkey AS doc_id, 'title' AS field, "
    "o_orderpriority || ' order ' || CAST(o_custkey AS VARCHAR) AS v FROM orders"
)
_TFN = f"({{tf}} * {K1 + 1} / ({{tf}} + {K1} * (1 - {B} + {B} * dl / avgdl)))"
_IDF = "ln(1 + (n_docs - {df} + 0.5) / ({df} + 0.5))"
_SCORED = f"""sc AS (SELECT post.field, post.term, post.doc_id,
  {_IDF.format(df='df')} * {_TFN.format(tf='tf')} AS s
  FROM post JOIN dfs USING (field, term) JOIN len USING (field, doc_id) JOIN st USING (field))"""


def _terms(*terms: str) -> str:
    return ", ".join(map(_quoted, terms))


def _constant(index: str, condition: str) -> str:
    return f"""WITH {index}
SELECT DISTINCT doc_id, CAST(1.0 AS DOUBLE) AS score FROM post WHERE {condition}"""


def _phrases(*phrases: list[tuple[int, str]]) -> str:
    ctes, froms, scores = [], "", []
    for i, phrase in enumerate(phrases):
        joins = " ".join(
            f"JOIN ft p{k} ON p{k}.doc_id = p0.doc_id AND p{k}.term = {_quoted(term)} "
            f"AND p{k}.pos = p0.pos + {offset - phrase[0][0]}"
            for k, (offset, term) in enumerate(phrase)
            if k
        )
        ctes.append(
            f"f{i} AS (SELECT p0.doc_id, count(*) AS fr FROM ft p0 {joins} "
            f"WHERE p0.term = {_quoted(phrase[0][1])} GROUP BY p0.doc_id)"
        )
        idf = " + ".join(
            _IDF.format(df=f"(SELECT df FROM dfs WHERE term = {_quoted(term)})")
            for _, term in phrase
        )
        scores.append(f"({idf}) * {_TFN.format(tf=f'f{i}.fr')}")
        froms += f"FROM f{i}" if i == 0 else f" JOIN f{i} USING (doc_id)"
    return f"""WITH {_TEXT}, {', '.join(ctes)}
SELECT doc_id, round({' + '.join(scores)}, 6) AS score
{froms} JOIN len USING (doc_id) JOIN st USING (field)"""


# A swap and at most one more edit, in two parts that don't overlap.
_SWAPS = """len(list_filter(
    flatten(list_transform(range(1, length(t)), lambda i: list_transform(range(1, length(q)),
      lambda j: struct_pack(i := i, j := j)))), lambda s: substr(t, s.i, 1) = substr(q, s.j + 1, 1) AND substr(t, s.i + 1, 1) = substr(q, s.j, 1)
      AND damerau_levenshtein(substr(t, 1, s.i - 1), substr(q, 1, s.j - 1))
        + damerau_levenshtein(substr(t, s.i + 2), substr(q, s.j + 2)) <= 1)) > 0"""
# Distances here count bytes: every letter beyond ASCII becomes one of its own.
_BYTES = "translate({}, 'àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&')"
# Here they become the same one, as the word has none.
_FUZZY = f"""near AS (SELECT term, df, q, CASE WHEN t = q THEN 0
    WHEN damerau_levenshtein(t, q) = 1 THEN 1 ELSE 2 END AS edits
  FROM (SELECT term, df, 'thiner' AS q, regexp_replace(term, '[^\\x00-\\x7F]', 'X', 'g') AS t FROM dfs)
  WHERE levenshtein(t, q) <= 2 OR {_SWAPS}),
best AS (SELECT term, df, edits, 1 - edits / least(length(term), length(q)) AS similarity
  FROM near WHERE edits < least(length(term), length(q)))"""

_BATCH = rf"""qw AS (SELECT query_id, term, count(*) AS weight FROM (
    SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS term
    FROM benchmark) WHERE term NOT IN ({_STOP}) GROUP BY ALL),
hits AS (SELECT query_id, doc_id, sum(weight * s) AS score FROM sc JOIN qw USING (term) GROUP BY ALL)"""


_ITEM_WORDS = rf"""q AS (SELECT item_id AS query_id, list_filter(string_split_regex(lower(text), '{_WS}'),
    lambda x: regexp_full_match(x, '\p{{L}}+')) AS w FROM benchmark)"""

_QUERY_TEXTS = f"""{_ITEM_WORDS},
lw AS (SELECT query_id, query_id % 8 AS t, k, w[k] AS term FROM (SELECT *, unnest(range(1, 7)) AS k FROM q)),
lv AS (SELECT query_id, t, bool_or(k = 1) AS la, bool_or(k = 2) AS lb, bool_or(k = 3) AS lc FROM lw
  WHERE term NOT IN ({_STOP}) GROUP BY ALL),
pw AS (SELECT query_id, k AS off, term FROM lw WHERE term NOT IN ({_STOP}) AND (t = 1 AND k <= 3 OR t = 5 AND k IN (2, 3))),
pn AS (SELECT query_id, count(*) AS n, sum({_IDF.format(df='df')}) AS idf FROM pw JOIN dfs USING (term) JOIN st USING (field) GROUP BY ALL),
pz AS (SELECT query_id, count(*) AS m FROM pw GROUP BY ALL),
pm AS (SELECT query_id, doc_id, pos - off AS at, count(*) AS c FROM pw JOIN ft USING (term) GROUP BY ALL),
pf AS (SELECT query_id, doc_id, count(*) AS fr FROM pm JOIN pz USING (query_id) WHERE c = m GROUP BY ALL),
sa AS (SELECT query_id, doc_id, k, s FROM lw JOIN sc USING (term)
  UNION ALL SELECT query_id, doc_id, 7, idf * {_TFN.format(tf='fr')} FROM pf JOIN pn USING (query_id) JOIN len USING (doc_id) JOIN st USING (field)
  UNION ALL SELECT DISTINCT query_id, doc_id, 8, 1.0 FROM lw JOIN post ON starts_with(post.term, substr(lw.term, 1, 4)) WHERE t = 6 AND k = 6
  UNION ALL SELECT DISTINCT query_id, doc_id, 8, 1.0 FROM lw JOIN post ON post.term BETWEEN lw.term AND lw.term || 'zz' WHERE t = 7 AND k = 6),
v AS (SELECT query_id, query_id % 8 AS t, doc_id, {', '.join(f"max(s) FILTER (k = {k}) AS {n}" for k, n in enumerate('abcdefpx', 1))} FROM sa GROUP BY ALL)
SELECT query_id, doc_id, round(CASE
  WHEN t IN (0, 4) THEN coalesce(a, 0) + coalesce(b, 0) WHEN t = 1 THEN p
  WHEN t = 2 THEN coalesce(a, 0) + coalesce(b, 0) WHEN t = 5 THEN coalesce(a, 0) + coalesce(p, 0) + coalesce(f, 0)
  WHEN t = 6 THEN x + coalesce(b, 0) ELSE coalesce(x, 0) + coalesce(c, 0) END, 6) AS score
FROM v LEFT JOIN lv USING (query_id, t) LEFT JOIN pz USING (query_id) WHERE CASE
  WHEN t IN (0, 4) THEN a IS NOT NULL OR b IS NOT NULL WHEN t = 1 THEN p IS NOT NULL
  WHEN t = 2 THEN (NOT coalesce(la, false) OR a IS NOT NULL) AND (NOT coalesce(lb, false) OR b IS NOT NULL) AND c IS NULL AND (a IS NOT NULL OR b IS NOT NULL)
  WHEN t = 5 THEN (a IS NOT NULL OR p IS NOT NULL OR NOT coalesce(la, false) AND m IS NULL) AND d IS NULL AND e IS NULL
    AND (a IS NOT NULL OR p IS NOT NULL OR f IS NOT NULL)
  WHEN t = 6 THEN x IS NOT NULL WHEN t = 7 THEN x IS NOT NULL OR c IS NOT NULL ELSE false END"""

_SLOP = f"""{_ITEM_WORDS},
pw AS (SELECT query_id, off, term, row_number() OVER (PARTITION BY query_id ORDER BY off) - 1 AS slot
  FROM (SELECT query_id, unnest([0, 1, 2]) AS off, unnest([w[2], w[1], w[4]]) AS term FROM q) WHERE term NOT IN ({_STOP})),
pn AS (SELECT query_id, count(*) AS n, max(off) FILTER (slot = 0) AS o0, max(off) FILTER (slot = 1) AS o1,
  max(off) FILTER (slot = 2) AS o2 FROM pw GROUP BY ALL),
pi AS (SELECT query_id, sum({_IDF.format(df='df')}) AS idf FROM pw JOIN dfs USING (term) JOIN st USING (field) GROUP BY ALL),
ev AS (SELECT query_id, doc_id, slot, pos, pos - off AS place FROM pw JOIN ft USING (term)),
nx AS (SELECT *, {', '.join(f"min(place) FILTER (slot = {k}) OVER later AS n{k}" for k in range(3))} FROM ev
  WINDOW later AS (PARTITION BY query_id, doc_id ORDER BY place, slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
mt AS (SELECT query_id, doc_id, place, n, [n0, n1, n2][slot + 1] AS own,
  list_filter([{', '.join(f"struct_pack(k := {k}, x := n{k}, p := n{k} + o{k})" for k in range(3))}], lambda o: o.k <> slot AND o.k < n) AS others, pos
  FROM nx JOIN pn USING (query_id)),
hit AS (SELECT query_id, doc_id, CASE WHEN n = 1 THEN 1.0 ELSE 1 / (1 + list_max(list_transform(others, lambda o: o.x)) - place) END AS f
  FROM mt WHERE n = 1 OR (len(list_filter(others, lambda o: o.x IS NULL OR o.p = pos)) = 0
    AND (own IS NULL OR own > list_min(list_transform(others, lambda o: o.x)))
    AND list_max(list_transform(others, lambda o: o.x)) - place <= query_id % 6)),
fr AS (SELECT query_id, doc_id, sum(f) AS fr FROM hit GROUP BY ALL)
SELECT query_id, doc_id, round(idf * {_TFN.format(tf='fr')}, 6) AS score
FROM fr JOIN pi USING (query_id) JOIN len USING (doc_id) JOIN st USING (field)"""

_WORDS = f"{_ITEM_WORDS}, bw AS (SELECT DISTINCT unnest(w) AS key FROM q)"


def _fuzzy_scores(chosen: str) -> str:
    return f"""WITH {_TEXT}, {_FUZZY}, kept AS ({chosen}), top AS (SELECT max(df) AS tdf FROM kept)
SELECT doc_id, round(sum(similarity * {_IDF.format(df='tdf')} * {_TFN.format(tf='tf')}), 6) AS score
FROM post JOIN kept USING (term) JOIN len USING (field, doc_id) JOIN st USING (field) CROSS JOIN top GROUP BY doc_id"""


_DISMAX = f"""WITH {_PART}, {_SCORED},
f AS (SELECT doc_id, field, sum(s) AS s FROM sc WHERE term IN ({_terms('small', 'widget')}) GROUP BY ALL)
SELECT doc_id, round(max(s) + 5 * (sum(s) - max(s)), 6) AS score FROM f GROUP BY doc_id"""


def _lines() -> str:
    parts = {
        "term text from": "SELECT doc_id, s AS score FROM sc WHERE term = 'from'",
        "boolean text +From +er ha": f"""SELECT doc_id, sum(s) AS score FROM sc WHERE term IN ({_terms('from', 'er', 'ha')})
AND doc_id IN (SELECT doc_id FROM post WHERE term = 'from') AND doc_id IN (SELECT doc_id FROM post WHERE term = 'er') GROUP BY doc_id""",
        'phrase text "de la"': f"SELECT * FROM ({_phrases([(0, 'de'), (1, 'la')])})",
        "multiphrase text (de la) and (la der)": f"""SELECT doc_id, sum(CASE WHEN term = 'la' THEN 2 * s ELSE s END) AS score
FROM sc WHERE term IN ({_terms('de', 'la', 'der')}) GROUP BY doc_id""",
        "prefix text thin": "SELECT DISTINCT doc_id, 1.0 AS score FROM post WHERE starts_with(term, 'thin')",
        "termrange text tha,thd": "SELECT DISTINCT doc_id, 1.0 AS score FROM post WHERE term BETWEEN 'tha' AND 'thd'",
        "wildcard text t?e*ing": "SELECT DISTINCT doc_id, 1.0 AS score FROM post WHERE term LIKE 't_e%ing'",
        "matchall": "SELECT p_partkey AS doc_id, 1.0 AS score FROM part",
    }
    union = " UNION ALL ".join(f"SELECT {_quoted(line)} AS line, doc_id, CAST(score AS DOUBLE) AS score FROM ({sql})" for line, sql in parts.items())
    return f"""WITH {_TEXT}, {_SCORED} SELECT line, doc_id, round(score, 6) AS score FROM ({union}
UNION ALL SELECT 'disjunction 5; name type; small widget', doc_id, score FROM ({_DISMAX}))"""


_MARKS = r"[\p{M}\x{200d}]*"
_SPECIAL = r"\p{Han}\p{Hiragana}\p{Katakana}\x{30fc}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
_L, _N = rf"(?:[^\P{{L}}{_SPECIAL}]{_MARKS})+", rf"(?:\p{{N}}{_MARKS})+"
_SEGMENTS = (
    rf"[\p{{Han}}\p{{Hiragana}}]{_MARKS}|(?:[\p{{Katakana}}\x{{30fc}}]{_MARKS})+|(?:[\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}]{_MARKS})+"
    rf"|(?:_*(?:{_L}(?:[:.·''’]{_L})*|{_N}(?:[.,;''’]{_N})*))+_*"
)
_BATCH_TOP10 = f"""WITH {_TEXT}, {_SCORED}, {_BATCH},
r AS (SELECT query_id, doc_id, round(score, 6) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM hits)
SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"""


def _author_split(pieces: str) -> str:
    return f"""WITH n AS (SELECT s_suppkey, s_name || ' and Alexander ' || n_name AS author
  FROM supplier JOIN nation ON s_nationkey = n_nationkey), p AS (SELECT s_suppkey, {pieces} AS w FROM n)
SELECT s_suppkey, CAST(ord - 1 AS INTEGER) AS ord, name FROM (
  SELECT s_suppkey, unnest(w) AS name, generate_subscripts(w, 1) AS ord FROM p)"""


def all_oracles() -> dict[str, str]:
    letters = " UNION ALL ".join(
        f"SELECT '{c}' AS letter, CAST(COALESCE(sum(length(t) - length(replace(t, '{c}', ''))), 0) AS BIGINT) AS n FROM l"
        for c in "abcdefghijklmnopqrstuvwxyz"
    )
    punctuation = r"[!-/:-@\[-`{-~]+"
    return {
        "letter_counts": f"WITH l AS (SELECT lower(text) AS t FROM documents) {letters}",
        "unigram_counts": _ngram_counts(1),
        "bigram_counts": _ngram_counts(2),
        "trigram_counts": _ngram_counts(3),
        "bigram_by_lang": _ngram_counts(2, "lang,"),
        "unigrams_alphabetical": _ngram_counts(1),
        "unigrams_ranked": _ranked(1),
        "bigrams_ranked": _ranked(2),
        "streamed_bigrams_ranked": _ranked(2),
        "trigrams_ranked": _ranked(3),
        "corpus_scan_ranked": f"""WITH numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY doc_id) - 1 AS place FROM documents),
r AS ({_ranked(2)})
SELECT ngram, n, place AS first_doc, first_pos FROM r JOIN numbered ON first_doc = doc_id""",
        "tokens_strip_first": rf"""WITH t AS (SELECT unnest(string_split_regex(
  regexp_replace(lower(text), '{punctuation}', '', 'g'), '{_WS}')) AS ngram FROM documents)
SELECT ngram, count(*) AS n FROM t WHERE ngram <> '' GROUP BY ngram""",
        "merged_counts": _ngram_counts(1),
        "frequency_files": " UNION ALL ".join(
            f"SELECT '{name}' AS name, ngram, n FROM ({_ngram_counts(n)})"
            for n, names in {1: ("uni", "uni_alpha"), 2: ("bi_dat", "bii_alpha"), 3: ("tri_dat", "tii_alpha")}.items()
            for name in names
        )
        + f" UNION ALL SELECT 'letters', letter, n FROM (WITH l AS (SELECT lower(text) AS t FROM documents) {letters})",
        "corpus_scan_letters": f"WITH l AS (SELECT lower(text) AS t FROM documents) {letters}",
        "corpus_scan_unigrams": _ngram_counts(1),
        "corpus_lines_terms": f"WITH {_CLEAN_TOKENS} SELECT term, count(*) AS total FROM tok GROUP BY term",
        "streamed_unigrams": _ngram_counts(1),
        "clean_token_counts": f"WITH {_CLEAN_TOKENS} SELECT term AS ngram, count(*) AS n FROM tok GROUP BY term",
        "stemmed_vocabulary": f"WITH {_STEMS} SELECT term, stem FROM stems",
        "stemmed_term_counts": f"""WITH {_STEMS}
SELECT stem AS term, count(*) AS n FROM tok JOIN stems USING (term) GROUP BY stem""",
        "postings_positions": f"""WITH {_CLEAN_TOKENS}
SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf,
  string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions FROM tok GROUP BY ALL""",
        "postings_dump": f"""WITH {_CLEAN_TOKENS}
SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf,
  string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions FROM tok GROUP BY ALL""",
        "postings_summary": f"""WITH {_CLEAN_TOKENS}
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS total FROM tok GROUP BY term""",
        "term_lookup": f"""WITH {_CLEAN_TOKENS}
SELECT doc_id, count(*) AS tf FROM tok WHERE term = 'from' GROUP BY doc_id""",
        "saved_postings_lookup": f"""WITH {_STEMS}
SELECT doc_id, count(*) AS tf FROM tok JOIN stems USING (term) WHERE stem = 'from' GROUP BY doc_id""",
        "phrase_pair": _near("of", "the", 1),
        "phrase_pair_ordered": _near("of", "the", 1, ordered=True),
        "proximity_3": _near("from", "the", 3),
        "proximity_self": _near("la", "la", 5),
        "proximity_documents": f"""SELECT doc_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM ({_near("die", "der", 4)}) GROUP BY doc_id""",
        "proximity_batch": f"""WITH {_CLEAN_TOKENS}, {_PAIRS}, {_near_tokens('tok')}
{_MATCHES_PER_QUERY}""",
        "position_queries": f"""WITH {_PAIRS}, {_stem_ctes('SELECT w1 AS term FROM q UNION ALL SELECT w2 FROM q')}
SELECT query_id, a.stem AS w1, max_dist, b.stem AS w2
FROM q JOIN stems a ON a.term = q.w1 JOIN stems b ON b.term = q.w2""",
        "position_queries_run": f"""WITH {_CLEAN_TOKENS},
q0 AS (SELECT * FROM (WITH {_PAIRS} SELECT * FROM q)),
{_stem_ctes('SELECT term FROM tok UNION ALL SELECT w1 FROM q0 UNION ALL SELECT w2 FROM q0')},
q AS (SELECT query_id, a.stem AS w1, max_dist, b.stem AS w2
  FROM q0 JOIN stems a ON a.term = q0.w1 JOIN stems b ON b.term = q0.w2),
stok AS (SELECT doc_id, pos, stem AS term FROM tok JOIN stems USING (term)), {_near_tokens('stok')}
{_MATCHES_PER_QUERY}""",
        "field_stats": f"WITH {_PART} SELECT field, n_docs, round(avgdl, 6) AS avg_len FROM st",
        "vocabulary": f"WITH {_TEXT} SELECT term, df FROM dfs",
        "term_vectors": f"""WITH {_TEXT}
SELECT doc_id, term, count(*) AS tf, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM ft GROUP BY doc_id, term""",
        "term_search": f"WITH {_TEXT}, {_SCORED} SELECT doc_id, round(s, 6) AS score FROM sc WHERE term = 'from'",
        "term_bm25_top10": f"""WITH {_TEXT}, {_SCORED}
SELECT doc_id, round(s, 6) AS score, printf('%.3f', round(s, 6)) AS shown FROM sc WHERE term = 'th'
ORDER BY s DESC, doc_id LIMIT 10""",
        "boolean_search": f"""WITH {_TEXT}, {_SCORED}
SELECT doc_id, round(sum(s), 6) AS score FROM sc WHERE term IN ({_terms('from', 'er', 'ha')})
AND doc_id IN (SELECT doc_id FROM post WHERE term = 'from')
AND doc_id IN (SELECT doc_id FROM post WHERE term = 'er')
AND doc_id NOT IN (SELECT doc_id FROM post WHERE term = 'ing') GROUP BY doc_id""",
        "boolean_search_optional": f"""WITH {_TEXT}, {_SCORED}
SELECT doc_id, round(sum(s), 6) AS score FROM sc WHERE term IN ({_terms('thor', 'que')})
AND doc_id NOT IN (SELECT doc_id FROM post WHERE term = 'de') GROUP BY doc_id""",
        "phrase_search": _phrases([(0, "de"), (1, "la")]),
        "phrase_search_gap": _phrases([(0, "from"), (2, "er")]),
        "multi_phrase_any": f"""WITH {_TEXT}, {_SCORED}
SELECT doc_id, round(sum(s), 6) AS score FROM sc WHERE term IN ({_terms('de', 'la', 'und', 'der')}) GROUP BY doc_id""",
        "multi_phrase_all": _phrases([(0, "de"), (1, "la")], [(0, "la"), (1, "de")]),
        "prefix_search": _constant(_TEXT, "starts_with(term, 'tho')"),
        "wildcard_search": _constant(_TEXT, "term LIKE 't_e%ing'"),
        "wildcard_search_parts": _constant(_PART, "field = 'name' AND term LIKE '%i_get'"),
        "regex_search": _constant(_TEXT, "regexp_full_match(term, '(th|er)+in(g|ed)?')"),
        "termrange_search": """SELECT o_orderkey AS doc_id, CAST(1.0 AS DOUBLE) AS score FROM orders
WHERE CAST(year(o_orderdate) AS VARCHAR) BETWEEN '1996' AND '1998'""",
        "fuzzy_terms": f"""WITH {_TEXT}, {_FUZZY}
SELECT term, df, CAST(edits AS INTEGER) AS edits, round(similarity, 6) AS similarity FROM best""",
        "fuzzy_search": _fuzzy_scores("SELECT * FROM best"),
        "fuzzy_search_50": _fuzzy_scores("SELECT * FROM best ORDER BY similarity DESC, term LIMIT 50"),
        "refused_calls": " UNION ALL ".join(
            f"SELECT {_quoted(call)} AS call, true AS refused"
            for call in ("index of no documents", "append to no index", "no such folder", "unknown query type",
                         "unbalanced query text", "multiplier that is no number")
        ),
        "dismax_search": _DISMAX,
        "search_lines": _lines(),
        "term_search_one_byte": f"""WITH {_TEXT},
short AS (SELECT field, doc_id, CASE WHEN dl < 40 THEN dl ELSE 24 + (((dl - 24) >> CAST(floor(log2(dl - 24)) - 3 AS BIGINT))
  << CAST(floor(log2(dl - 24)) - 3 AS BIGINT)) END AS dl FROM len)
SELECT doc_id, round({_IDF.format(df='df')} * {_TFN.format(tf='tf')}, 6) AS score
FROM post JOIN dfs USING (field, term) JOIN short USING (field, doc_id) JOIN st USING (field) WHERE term = 'from'""",
        "segmented_words": rf"""WITH texts AS (SELECT text FROM documents UNION ALL
  SELECT replace(text, 'é', 'e' || chr(769)) || ' 日本語テストー ひら don''t 3.14 1,000.5 a_b ก็ดี x.1 ' || repeat('y', 300) FROM documents),
w AS (SELECT unnest(regexp_extract_all(lower(text), '{_SEGMENTS}')) AS term FROM texts),
cut AS (SELECT unnest([term[i:i + 254] FOR i IN range(1, length(term) + 1, 255)]) AS term FROM w)
SELECT term, count(*) AS n FROM cut GROUP BY term""",
        "top10_and_total": f"""WITH {_TEXT}, {_SCORED},
h AS (SELECT doc_id, round(sum(s), 6) AS score FROM sc WHERE term IN ({_terms('from', 'er', 'ha')}) GROUP BY doc_id)
SELECT doc_id, score, (SELECT count(*) FROM h) AS n_hits FROM h ORDER BY score DESC, doc_id LIMIT 10""",
        "merged_index_search": f"""WITH {_index("SELECT doc_id, 'text' AS field, text AS v FROM documents WHERE doc_id % 7 <> 0")}, {_SCORED}
SELECT doc_id, round(sum(s), 6) AS score FROM sc WHERE term IN ({_terms('from', 'er', 'ha')}) GROUP BY doc_id""",
        "index_modes": f"WITH {_PART} SELECT field, n_docs, round(avgdl, 6) AS avg_len FROM st WHERE field = 'type'",
        "query_text_hits": f"WITH {_TEXT}, {_SCORED}, {_QUERY_TEXTS}",
        "phrase_slop_batch": f"WITH {_TEXT}, {_SLOP}",
        "wildcard_batch": f"""WITH {_TEXT}, {_WORDS}
SELECT key, term, df FROM bw JOIN dfs ON term LIKE '%' || substr(key, 2, 3) || '%' || key[-1]""",
        "regex_batch": f"""WITH {_TEXT}, {_WORDS},
near AS (SELECT key, term, df FROM bw JOIN dfs ON contains(term, substr(key, 1, 3)) AND length(term) <= length(substr(key, 1, 5)) + 4)
SELECT key, term, df FROM near
WHERE regexp_full_match(term, '[a-z]?' || substr(key, 1, 3) || '(e|i[a-z])?' || substr(key, 4, 2) || '.')""",
        "fuzzy_batch": f"""WITH {_TEXT}, {_WORDS},
plain AS (SELECT term, df, {_BYTES.format('term')} AS t FROM dfs), asked AS (SELECT key, {_BYTES.format('key')} AS q FROM bw),
few AS (SELECT key, term, df, t, q FROM plain JOIN asked ON abs(length(t) - length(q)) <= 2 AND damerau_levenshtein(t, q) <= 2),
near AS (SELECT key, term, df, CASE WHEN t = q THEN 0 WHEN damerau_levenshtein(t, q) = 1 THEN 1 ELSE 2 END AS edits
  FROM few WHERE levenshtein(t, q) <= 2 OR {_SWAPS})
SELECT key, term, df, CAST(edits AS INTEGER) AS edits, round(1 - edits / least(length(term), length(key)), 6) AS similarity
FROM near WHERE edits < least(length(term), length(key))""",
        "match_all": "SELECT p_partkey AS doc_id, CAST(1.0 AS DOUBLE) AS score FROM part",
        "match_all_count": "SELECT count(*) AS n_hits FROM part",
        "hit_totals": f"WITH {_TEXT}, {_SCORED}, {_BATCH} SELECT query_id, count(*) AS n_hits FROM hits GROUP BY query_id",
        "batch_top10": _BATCH_TOP10,
        "block_max_top10": _BATCH_TOP10,
        "clustered_top10": _BATCH_TOP10,
        "saved_index_search": f"""WITH {_TEXT}, {_SCORED}
SELECT CASE WHEN lang = 'en' THEN doc_id ELSE doc_id + 1 + (SELECT max(doc_id) FROM documents WHERE lang = 'en') END AS doc_id,
  round(sum(s), 6) AS score FROM sc JOIN documents USING (doc_id) WHERE term IN ({_terms('de', 'from', 'er')}) GROUP BY doc_id, lang""",
        "bib_roundtrip": "SELECT p_partkey, 'part' AS type, p_name, p_brand, p_type, p_size FROM part",
        "bib_loose_layout": "SELECT p_partkey, 'part' AS type, p_name, p_brand, p_type, p_size FROM part",
        "bib_index_search": f"""WITH {_ORDER_TITLES}, {_SCORED}
SELECT doc_id AS o_orderkey, round(sum(s), 6) AS score FROM sc JOIN orders ON o_orderkey = doc_id
WHERE term IN ({_terms('urgent', '7', '77', '100')}) AND year(o_orderdate) BETWEEN 1996 AND 1997
AND doc_id IN (SELECT doc_id FROM post WHERE term = 'urgent')
GROUP BY doc_id ORDER BY round(sum(s), 6) DESC, doc_id LIMIT 10""",
        "bib_state": """SELECT o.o_orderkey, 'Müller, ' || o.o_orderstatus AS author,
  'mail us' || chr(10) || '@home or {' || o.o_orderpriority || '}' || chr(10) || '@misc{x, title = {y}}' || chr(10) AS note,
  coalesce('House ' || CAST(max(CASE WHEN o.o_orderkey % 512 = 0 THEN o.o_orderkey // 512 END)
    OVER (PARTITION BY o.o_orderkey // 8192 ORDER BY o.o_orderkey) AS VARCHAR), 'house') || ' Inc' AS publisher,
  'Series ' || CAST(p.o_custkey AS VARCHAR) AS series, true AS complete
FROM orders o LEFT JOIN orders p ON p.o_orderkey = (o.o_orderkey // 32) * 32""",
        "bib_fields": """WITH o AS (SELECT o_orderkey AS doc_id, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s,
  o_orderpriority AS p, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders)
SELECT doc_id, 'type' AS field, 'order' AS "values" FROM o
UNION ALL SELECT doc_id, 'author', 'Clerk ' || c || '|' || s || ', Anderson' FROM o
UNION ALL SELECT doc_id, 'title', 'Order ' || p || ': x' FROM o
UNION ALL SELECT doc_id, 'year', y FROM o
UNION ALL SELECT doc_id, 'key', 'Clerk-' || y || '-Order-' || replace(p, ' ', '-') FROM o""",
        "bib_bad_entries": "SELECT count(*) AS n_bad FROM orders WHERE o_orderstatus = 'O'",
        "entry_keys": """SELECT p_partkey, CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment
  WHEN p_brand NOT LIKE '%7' THEN split_part(p_brand || ' Editor', ' ', 1) END || '-' || CAST(p_size AS VARCHAR) || '-'
  || replace(p_name || ' ' || p_brand, ' ', '-') AS key FROM part LEFT JOIN customer ON p_partkey = c_custkey""",
        "author_split_clean": _author_split(r"string_split_regex(author, '\s+and\s+')"),
        "author_split_literal": _author_split("string_split(author, 'and')"),
    }
