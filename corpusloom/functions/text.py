"""Tokenizers and n-grams as column expressions.

All functions take a string column and return an ``array<string>``. Operators should
explode these expressions with :func:`explode_words` (an *outer* explode followed by
a null filter): exploding a plain array column makes Catalyst infer a
``size(array) > 0`` filter and push it to the scan, where the whole tokenization
would be evaluated again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values -----------------------------------------------------------------
# Characters that separate words for the letters-only tokenizer (Unicode white space,
# including the four ASCII information separators), as a character-class body.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x85\xa0"
    r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Cleaning tokenizer: characters deleted, and characters turned into a space.
CLEAN_DELETED = "@#$%^&?<>*()\t=-;\\][\"'"
CLEAN_SPACED = "\n\r!.,:"
# English stop words removed by the standard analyzer.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the "
    "their then there these they this to was will with"
).split()
# ----------------------------------------------------------------------------------

_LETTERS_ONLY = r"\A\p{L}++\z"
_MARKS = r"[\p{M}\u200d]*+"
_SINGLE = r"\p{IsHan}\p{IsHiragana}"
_KATAKANA = r"\p{IsKatakana}\u30fc"
_UNSPACED = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_LETTERS = rf"(?:[^\P{{L}}{_SINGLE}{_KATAKANA}{_UNSPACED}]{_MARKS})++"
_DIGITS = rf"(?:\p{{N}}{_MARKS})++"
_RUN = rf"(?:{_LETTERS}(?:[:.·'’]{_LETTERS})*+|{_DIGITS}(?:[.,;'’]{_DIGITS})*+)"
_UNICODE_WORD = (
    rf"[{_SINGLE}]{_MARKS}|(?:[{_KATAKANA}]{_MARKS})++|(?:[{_UNSPACED}]{_MARKS})++|(?:_*+{_RUN})++_*+"
)
LONGEST_WORD = 255


def words_alpha(text: Column, strip_first: bool = False) -> Column:
    """White-space words, lowercased, kept only when made of letters alone.

    A word with any digit or punctuation (``end.``, ``don't``) is dropped whole.
    ``strip_first=True`` instead deletes ASCII punctuation from every word and keeps
    what is not blank.
    """
    lowered = F.lower(text)
    if strip_first:
        stripped = F.regexp_replace(lowered, r"\p{Punct}++", "")
        return F.array_remove(F.split(stripped, f"[{WHITESPACE}]+"), "")
    return F.filter(
        F.split(lowered, f"[{WHITESPACE}]+"), lambda w: w.rlike(_LETTERS_ONLY)
    )


def words_clean(text: Column) -> Column:
    """Lowercase, delete one set of characters, blank another, split on spaces.

    Deleting tab and hyphen joins the neighbours: ``well-known`` is ``wellknown``.
    """
    cleaned = F.translate(
        F.lower(text), CLEAN_SPACED + CLEAN_DELETED, " " * len(CLEAN_SPACED)
    )
    return F.array_remove(F.split(cleaned, " "), "")


def words_standard(text: Column, unicode_words: bool = False) -> Column:
    """Lowercased runs of letters and digits, stop words still in place.

    ``unicode_words=True`` cuts by classes of characters as word-boundary segmentation does: combining marks
    belong to what they follow, inner apostrophes, stops and digit separators stay (``don't``, ``3.14``), underscores join,
    ideographs and hiragana are words one by one, katakana and scripts without spaces are whole runs. Words longer than 255
    characters are cut.
    """
    lowered = F.lower(text)
    if unicode_words:
        words = F.regexp_extract_all(lowered, F.lit(_UNICODE_WORD), F.lit(0))

        def bounded(words: Column) -> Column:
            long = F.exists(words, lambda w: F.length(w) > LONGEST_WORD)
            return F.when(long, F.flatten(F.transform(words, _cut))).otherwise(words)

        # An array of one, so that the text is read once.
        return F.get(F.transform(F.array(words), bounded), F.lit(0))
    return F.array_remove(F.split(lowered, r"[^\p{L}\p{N}]++"), "")


def _cut(word: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(word), F.lit(LONGEST_WORD))
    return F.transform(starts, lambda at: F.substr(word, at, F.lit(LONGEST_WORD)))


def drop_stop_words(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(STOP_WORDS))


def word_ngrams(words: Column, n: int) -> Column:
    """Every run of ``n`` consecutive words joined by one space, in text order."""
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return words
    starts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(
        starts,
        lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, n)]),
    )


def explode_words(
    df: DataFrame, words: Column, *keep: str | Column, term: str = "term", pos: str = "pos"
) -> DataFrame:
    """One row per word: the ``keep`` columns, 1-based position and word."""
    exploded = df.select(*keep, F.posexplode_outer(words).alias(pos, term))
    kept = [c for c in exploded.columns if c not in (pos, term)]
    return exploded.where(F.col(term).isNotNull()).select(
        *kept, (F.col(pos) + 1).alias(pos), term
    )
