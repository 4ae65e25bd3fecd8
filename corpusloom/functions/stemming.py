"""Porter stemming of token arrays.

The stemmer itself is a small rule table. Tokens reach it as Arrow lists, one batch of
documents at a time, and every *distinct* token of a batch is stemmed once; the stems
are then spread back over the batch by dictionary index. No shuffle is involved, so a
word that makes up a third of the corpus costs the same as any other.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: suffix rules of the published algorithm (1980), plus the later
# --- extensions (logi, bli, fulli, four-letter -ies/-ied, irregular forms) ----------
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
STEP_4 = dict.fromkeys(
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split(),
    "",
)
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "inning": "inning", "innings": "inning", "outing": "outing",
    "outings": "outing", "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# ----------------------------------------------------------------------------------


def _suffix_split(rules: dict[str, str]):
    """Function from a word to ``(stem, longest rule suffix)``, or None."""
    ends, split = tuple(rules), re.compile(rf"(.*?)({'|'.join(rules)})\Z", re.S)
    return lambda word: split.match(word).groups() if word.endswith(ends) else None


# Words are examined in a marked spelling: a consonant y (first letter, or after a vowel)
# is written Y, so that vowels are exactly the letters aeiouy.
_MARK_Y = re.compile(r"(?<![^aeiou])y")
_MARK_YY = re.compile(r"yy")
_HAS_VOWEL = re.compile(r"[aeiouy]")
_M_POSITIVE = re.compile(r"[aeiouy][^aeiouy]")
_M_ABOVE_1 = re.compile(r"[aeiouy][^aeiouy]+[aeiouy]+[^aeiouy]")
_SHORT_END = re.compile(r"[^aeiouy][aeiouy][^aeiouywxY]\Z|\A[aeiouy][^aeiouy]\Z")
_DOUBLE_END = re.compile(r"([^aeiouyY])\1\Z|(?:yY|Yy)\Z(?<=Y)")
_split_2, _split_3, _split_4 = map(_suffix_split, (STEP_2, STEP_3, STEP_4))


def _mark(word: str) -> str:
    return _MARK_YY.sub("yY", _MARK_Y.sub("Y", word)) if "y" in word else word


def _plural(word: str) -> str:
    if not word.endswith("s"):
        return word
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word if word.endswith("ss") else word[:-1]


def _past_or_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _M_POSITIVE.search(word[:-3]) else word
    if word.endswith("ed"):
        stem = word[:-2]
    elif word.endswith("ing"):
        stem = word[:-3]
    else:
        return word
    if not _HAS_VOWEL.search(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _DOUBLE_END.search(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    once = _M_POSITIVE.search(stem) and not _M_ABOVE_1.search(stem)
    return stem + "e" if once and _SHORT_END.search(stem) else stem


def _final_y(word: str) -> str:
    # A lower-case y here is a vowel, hence it follows a consonant.
    return word[:-1] + "i" if word.endswith("y") and len(word) > 2 else word


def _derivation(word: str) -> str:
    found = _split_2(word)
    if not found:
        return word
    stem, suffix = found
    if not _M_POSITIVE.search(stem + "l" if suffix == "logi" else stem):
        return word
    replaced = stem + STEP_2[suffix]
    return _derivation(replaced) if suffix == "alli" else replaced


def _quality(word: str) -> str:
    found = _split_3(word)
    if not found or not _M_POSITIVE.search(found[0]):
        return word
    return found[0] + STEP_3[found[1]]


def _ending(word: str) -> str:
    found = _split_4(word)
    if not found or not _M_ABOVE_1.search(found[0]):
        return word
    if found[1] == "ion" and found[0][-1] not in "st":
        return word
    return found[0]


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _M_ABOVE_1.search(stem) or (
            _M_POSITIVE.search(stem) and not _SHORT_END.search(stem)
        ):
            word = stem
    return word[:-1] if word.endswith("ll") and _M_ABOVE_1.search(word[:-1]) else word


@lru_cache(maxsize=1 << 18)
def porter(word: str) -> str:
    """Stem one word (lowercased first); words of one or two letters stay."""
    word = word.lower()
    if word in IRREGULAR or len(word) <= 2:
        return IRREGULAR.get(word, word)
    word = _mark(word)
    for step in (
        _plural, _past_or_gerund, _final_y, _derivation, _quality, _ending, _tidy,
    ):
        word = step(word)
    return word.lower()


def _stem_values(values: pa.Array) -> pa.Array:
    coded = values.dictionary_encode()
    stems = pa.array([porter(w) for w in coded.dictionary.to_pylist()], pa.string())
    return stems.take(coded.indices)


def _stem_lists(lists: pa.Array) -> pa.Array:
    starts = lists.offsets
    shifted = pc.subtract(starts, starts[0])
    return pa.ListArray.from_arrays(
        shifted, _stem_values(lists.flatten()), mask=lists.is_null()
    )


def stem_words(words: Column) -> Column:
    """``array<string>`` of tokens to ``array<string>`` of their stems."""

    def stem(lists: pa.Array) -> pa.Array:
        return _stem_lists(lists)

    return F.arrow_udf(stem, "array<string>")(words)


def stem_vocabulary(terms: DataFrame, term: str = "term") -> DataFrame:
    """Distinct terms of a token frame with their stems: ``(term, stem)``."""

    def stem(values: pa.Array) -> pa.Array:
        return _stem_values(values)

    return terms.select(term).distinct().select(
        term, F.arrow_udf(stem, "string")(F.col(term)).alias("stem")
    )
