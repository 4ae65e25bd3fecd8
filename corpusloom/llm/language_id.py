"""Language identification: averaged hashed subword embeddings under a linear softmax.

The subwords of a text are all runs of one to ``LONGEST`` characters inside its words, with a mark for the edge of a
word; each is hashed to one of ``BUCKETS`` embeddings. A text is the mean of its embeddings, and a softmax over
a linear map of the mean gives the languages. Embeddings and map are trained together by stochastic
gradient descent on a bounded sample. Documents kept out of the descent fit a temperature, which makes the
probabilities honest, and the least probability at which a prediction is accepted.

As map and mean are both linear, a text is scored by the mean of mapped embeddings: a row with one number for each
language and bucket. Whole texts are read, in slices of bounded size.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import ship_package
from .tables import saved

LONGEST = 3
BUCKETS = 1 << 15
SIZE = 16
SAMPLE_ROWS = 4096
LANGUAGES = 256
EPOCHS = 6
RATE = 0.5
CALIBRATION = 5
PRECISION = 0.99
SEED = 31
SLICE = 1 << 18
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)


def subwords(codes: np.ndarray, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(place, bucket)`` of the subwords of each length that begin in the first ``starts`` code points.

    ``codes`` goes on as far as a subword can reach. Between words stand zeros; a zero at
    either end of a run is the edge of a word, and inside of it a run is no subword.
    """
    held = np.where(letters()[codes], codes, 0)
    is_letter = held != 0
    hashed = np.zeros(len(held), dtype=np.uint32)
    inside = np.ones(len(held), dtype=bool)
    for length in range(1, LONGEST + 1):
        count = min(starts, len(held) - length + 1)
        if count <= 0:
            return
        if length > 2:
            inside = inside[:count] & is_letter[length - 2 : length - 2 + count]
        hashed = (hashed[:count] + held[length - 1 : length - 1 + count]) * np.uint32(0x9E3779B1)
        hashed ^= hashed >> np.uint32(15)
        ends = is_letter[:count] | is_letter[length - 1 : length - 1 + count]
        place = np.flatnonzero(inside if length > 2 else ends)
        yield place, (hashed[place] >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _slices(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of a text with a zero on both sides, some at a time, and how many of them begin a subword."""
    codes = np.concatenate([[0], code_points(text), [0]]).astype(np.uint32)
    for low in range(0, len(codes), SLICE):
        yield codes[low : low + SLICE + LONGEST - 1], min(SLICE, len(codes) - low)


def bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's subwords and how often each occurs."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for codes, starts in _slices(text):
        for _, buckets in subwords(codes, starts):
            total += np.bincount(buckets, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass(frozen=True)
class LanguageModel:
    """Languages, the mapped embedding of each bucket, the offsets, the temperature and the least accepted score."""

    languages: list[str]
    mapped: np.ndarray
    offset: np.ndarray
    temperature: float
    least: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        scaled = (logits + self.offset) / self.temperature
        scaled = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        return scaled / scaled.sum(axis=1, keepdims=True)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean mapped embedding of each text, and whether it has a letter."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts), dtype=np.int64)
        for first, last in _groups(texts):
            lowered = [code_points(t) for t in texts[first:last]]
            sizes = np.array([len(c) + 1 for c in lowered])
            if last - first == 1 and sizes[0] > SLICE:
                for codes, starts in _slices(texts[first]):
                    for _, buckets in subwords(codes, starts):
                        count[first] += len(buckets)
                        total[first] += self.mapped[buckets].sum(axis=0, dtype=np.float64)
                continue
            edge = np.zeros(1, dtype=np.uint32)
            joined = np.concatenate([edge, *(part for codes in lowered for part in (codes, edge))])
            ends = np.cumsum(sizes)  # a text's subwords begin at the edge before it and end at that behind it
            for place, buckets in subwords(joined, len(joined)):
                cuts = np.searchsorted(place, np.r_[0, ends])
                sums = np.add.reduceat(np.vstack([self.mapped[buckets], np.zeros_like(self.mapped[:1])]), cuts[:-1], axis=0, dtype=np.float64)
                held = np.diff(cuts)
                total[first:last] += np.where(held[:, None] > 0, sums, 0)
                count[first:last] += held
        return total / np.maximum(count, 1)[:, None], count > 0


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a slice in all; a longer text is alone."""
    first, held = 0, 0
    for n, text in enumerate(texts):
        if n > first and held + len(text) > SLICE // 2:
            yield first, n
            first, held = n, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def descend(
    samples: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int = EPOCHS, rate: float = RATE
) -> tuple[np.ndarray, np.ndarray]:
    """Mapped embeddings and offsets after stochastic gradient descent over ``(buckets, counts, language)``.

    Languages have equal weight whatever their share of the samples.
    """
    rng = np.random.default_rng(SEED)
    embeddings = rng.uniform(-1, 1, (BUCKETS, SIZE)) / SIZE
    linear, offset = np.zeros((languages, SIZE)), np.zeros(languages)
    held = np.bincount([s[2] for s in samples], minlength=languages)
    weight = len(samples) / (np.maximum(held, 1) * np.count_nonzero(held))
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for n in rng.permutation(len(samples)):
            buckets, counts, language = samples[n]
            step = rate * (1 - done / steps) * min(weight[language], 4.0)
            done += 1
            shares = counts / counts.sum()
            mean = shares @ embeddings[buckets]
            logits = linear @ mean + offset
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[language] -= 1
            back = error @ linear
            linear -= step * error[:, None] * mean
            offset -= step * 0.1 * error
            embeddings[buckets] -= step * shares[:, None] * back * 20
    return embeddings @ linear.T, offset


def calibrate(logits: np.ndarray, truth: np.ndarray, precision: float) -> tuple[float, float]:
    """Temperature of least cross entropy, and the least score from which on ``precision`` of the predictions are right."""
    if not len(truth):
        return 1.0, 0.0
    losses = []
    grid = np.geomspace(0.05, 20, 121)
    for temperature in grid:
        scaled = logits / temperature
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        losses.append(np.mean(np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(truth)), truth]))
    temperature = float(grid[int(np.argmin(losses))])
    scaled = np.exp((logits - logits.max(axis=1, keepdims=True)) / temperature)
    score = (scaled / scaled.sum(axis=1, keepdims=True)).max(axis=1)
    right = logits.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    reached = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    if reached.all() or not reached.any():
        return temperature, 0.0 if reached.all() else 1.0
    return temperature, float(score[order][np.flatnonzero(reached)[-1]])


def train(samples: list[tuple[str, np.ndarray, np.ndarray, bool]], precision: float = PRECISION) -> LanguageModel:
    """Model from ``(language, buckets, counts, for calibration)``; samples without a letter are not learnt from."""
    samples = [s for s in samples if len(s[1])]
    languages = sorted({s[0] for s in samples})
    number = {language: n for n, language in enumerate(languages)}
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((BUCKETS, 1), dtype=np.float32), np.zeros(1), 1.0, 1.0)
    learnt = [(b, c, number[language]) for language, b, c, aside in samples if not aside]
    if {n for _, _, n in learnt} != set(range(len(languages))):  # too few to set any aside
        learnt = [(b, c, number[language]) for language, b, c, _ in samples]
    mapped, offset = descend(learnt, len(languages))
    aside = [s for s in samples if s[3]]
    logits = np.array([(c / c.sum()) @ mapped[b] + offset for _, b, c, _ in aside]).reshape(len(aside), len(languages))
    truth = np.array([number[s[0]] for s in aside], dtype=np.int64)
    temperature, least = calibrate(logits, truth, precision)
    return LanguageModel(languages, mapped.astype(np.float32), offset, temperature, least)


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from training: every fourth by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(
    docs: DataFrame, doc_id: str, text: str, lang: str, sample_rows: int = SAMPLE_ROWS, languages: int = LANGUAGES
) -> DataFrame:
    """``(lang, buckets, counts, aside)`` of at most ``2 * sample_rows`` learnable rows, as many of each language as can be.

    Of more than ``languages`` languages the most frequent are learnt. A row becomes its
    bucket counts in the task that reads it: texts of any length give at most :data:`BUCKETS` numbers.
    """
    usable = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    each = max(1, sample_rows // max(1, len(counts)))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    chosen = F.lit(False)
    for row in counts:
        below = round(min(1.0, each / row["count"]) * (1 << 30))
        chosen = chosen | ((F.col("lang") == row["lang"]) & (place < F.lit(below)))
    aside = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(CALIBRATION)) == 0
    few = usable.where(chosen).limit(2 * sample_rows).select("lang", "text", aside.alias("aside"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                buckets, counts = bucket_counts(batch["text"][n].as_py())
                yield pa.record_batch(
                    {
                        "lang": batch["lang"].slice(n, 1),
                        "buckets": pa.array([buckets.astype(np.int32)], pa.list_(pa.int32())),
                        "counts": pa.array([counts], pa.list_(pa.int64())),
                        "aside": batch["aside"].slice(n, 1),
                    }
                )

    return few.mapInArrow(counted, "lang string, buckets array<int>, counts array<bigint>, aside boolean")


def fit(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    languages: int = LANGUAGES,
    precision: float = PRECISION,
) -> LanguageModel:
    """A model of the languages of ``docs``, learnt from a bounded sample that comes to the driver as bucket counts."""
    ship_package(docs.sparkSession)
    rows = saved(sampled(docs, doc_id, text, lang, sample_rows, languages), "language-sample").collect()
    samples = [(r.lang, np.array(r.buckets, dtype=np.int64), np.array(r.counts, dtype=float), r.aside) for r in rows]
    samples.sort(key=lambda s: (s[0], s[3], len(s[1]), s[1].tobytes(), s[2].tobytes()))
    return train(samples, precision)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``.

    A text that is null or has no letter has the language ``und``, score 0, and isn't accepted. Any other gets the
    likeliest language; it is accepted if its score reaches the calibrated bound. Columns of
    these names are replaced; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def scored(texts):
        import pandas as pd

        held = [t or "" for t in texts]
        logits, known = model.logits(held)
        chances = model.probabilities(logits)
        best = chances.argmax(axis=1)
        score = np.where(known, chances[np.arange(len(held)), best], 0.0)
        named = np.array(model.languages, dtype=object)[best]
        return pd.DataFrame(
            {
                "lang_pred": np.where(known, named, UNKNOWN),
                "score": score,
                "accepted": known & (score >= model.least),
            }
        )

    name = "_found"
    while name in docs.columns:
        name += "_"
    found = docs.withColumn(name, scored(F.col(text).cast("string")))
    made = {c: F.col(f"{name}.{c}") for c in ("lang_pred", "score", "accepted")}
    return found.withColumns(made).drop(name)
