"""Language ID by rank-order profiles.

A profile is a text's most frequent n-grams in order of frequency. A document is
compared to each language's profile by the out-of-place distance: the sum, over
the document's n-grams, of how far their ranks differ; an n-gram that the
language's profile lacks counts as the profile's whole length.

N-grams are one to three letters of lower-cased words, with a space before and
after each word. Counting for the profiles is one pass over all training rows
that emits partial counts, so neither a language nor a document is one group's
work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.codepoints import LOWER, UPPER, classes, points
from changeflow.llm.common import col, free, worker_cache

PROFILE = 400
MAX_LANGUAGES = 2000
UNKNOWN = "und"
_SLICE = 1 << 18
_SPACE = 32
#: N-grams a task holds before it sums and emits them.
_FLUSH = 400_000


def _folded(text: str) -> np.ndarray:
    """Lower-cased letters, with one space before, between and after words; empty if there is no letter."""
    p = points(text.lower())
    kinds = classes()[p]
    letter = (kinds == LOWER) | (kinds == UPPER)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of several characters that aren't letters stands for all
    out = np.where(letter, p, _SPACE)[keep]
    if not letter.any():
        return np.zeros(0, np.uint32)
    out = out[1:] if out[0] == _SPACE else out
    return np.concatenate([[_SPACE], out, [_SPACE] if out[-1] != _SPACE else []]).astype(np.uint64)


def _sum_by(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, three code points of 21 bits in each number, and how often each comes."""
    t, parts = _folded(text), []
    for at in range(0, len(t), _SLICE):
        a = t[at : at + _SLICE + 2]
        n = min(_SLICE, len(t) - at)  # n-grams that begin in this slice
        one = a[:n] << np.uint64(42)
        two = (one[: len(a) - 1][: n] | a[1 : n + 1] << np.uint64(21)) if len(a) > 1 else one[:0]
        three = two[: len(a) - 2] | a[2 : n + 2] if len(a) > 2 else one[:0]
        letters = a != _SPACE
        inner = letters[1 : 1 + len(three)]
        parts.append(np.unique(np.concatenate([one[letters[:n]], two, three[inner]]), return_counts=True))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    return _sum_by(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))


def profile(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent first; ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        kept = counts >= least
        codes, counts = codes[kept], counts[kept]
    return codes[np.lexsort((codes, -counts))][:size]


@dataclass
class Profiles:
    """The languages' profiles, joined into one sorted list of n-grams with a rank for each language."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    def identify(self, text: str | None) -> tuple[str, float]:
        """The nearest language (the first by name of several) and 1 - distance / largest distance."""
        own = profile(*grams(text), self.size) if text else ()
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        place = np.searchsorted(self.codes, own)
        known = place < len(self.codes)
        known[known] = self.codes[place[known]] == own[known]
        ranks = np.full((len(own), len(self.languages)), -1, np.int32)
        ranks[known] = self.ranks[place[known]]
        mine = np.arange(len(own), dtype=np.int32)[:, None]
        away = np.where(ranks < 0, self.size, np.abs(ranks - mine)).sum(axis=0)
        best = int(away.argmin())
        return self.languages[best], 1.0 - float(away[best]) / (self.size * len(own))


def _emit(held: dict[str, list]) -> pa.RecordBatch:
    rows = [(lang, *_sum_by(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))) for lang, parts in held.items()]
    names = [x for lang, codes, _ in rows for x in [lang] * len(codes)]
    codes = np.concatenate([c for _, c, _ in rows]).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(codes), pa.array(np.concatenate([n for *_, n in rows]))], names=["lang", "gram", "n"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language, summed within the task as far as they fit."""
    worker_cache("languages")
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            codes, counts = grams(text.as_py())
            if len(codes):
                held.setdefault(lang.as_py(), []).append((codes, counts))
                size += len(codes)
            if size > _FLUSH:
                yield _emit(held)
                held, size = {}, 0
    if held:
        yield _emit(held)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of the languages in ``docs``, over all its rows with a language and a text.

    What comes to the driver is bounded: ``size`` n-grams for each of at most
    MAX_LANGUAGES languages; more languages raise an error.
    """
    rows = docs.select(col(lang).cast("string").alias("lang"), col(text).alias("text")).where("lang is not null and text is not null")
    counts = rows.mapInArrow(_partial_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(place) - 1).where(F.col("rank") < size).select("lang", "gram", "rank")
    found = top.limit(size * MAX_LANGUAGES + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES or len(found) > size * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    codes = np.unique(found["gram"].to_numpy().astype(np.uint64))
    ranks = np.full((len(codes), len(languages)), -1, np.int32)
    ranks[np.searchsorted(codes, found["gram"].to_numpy().astype(np.uint64)), np.searchsorted(languages, found["lang"])] = found["rank"]
    return Profiles(languages, codes, ranks, size)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score, 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text when no language was learned. Columns of these two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # bounded by learn()

    @F.arrow_udf("struct<lang: string, score: double>")
    def judged(texts: pa.Array) -> pa.Array:
        found = [shared.value.identify(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["lang", "score"])

    kept = [c for c in docs.columns if c.lower() not in (lang_pred.lower(), score.lower())]
    mark, = free(docs, "judged")
    out = docs.withColumn(mark, judged(col(text)))
    return out.select(*(col(c) for c in kept), col(mark)["lang"].alias(lang_pred), col(mark)["score"].alias(score))
