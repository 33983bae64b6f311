"""Secret scan with a random forest that removes false positives.

Candidates are found with wide patterns: long runs of token characters with a
digit in them, and whatever is assigned to a name such as key or password. Most
are not secrets. Each becomes features of its length, of its characters and the
transitions between their kinds, of how much of it dictionary words cover, of
the path it was found under and of the words beside it; a random forest trained
on labelled findings keeps or drops it.

The dictionary is the most frequent words of the corpus itself, counted over all
documents. The forest is Spark's, trained on at most ``max_rows`` findings.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import col, written

DICTIONARY = 5000
MAX_ROWS = 20_000
#: Names that secrets are given to.
NAMES = ("key", "token", "secret", "passwd", "password", "pwd", "auth", "credential", "bearer", "apikey")
PLACES = ("test", "example", "sample", "doc", "readme", "fixture", "mock", "vendor")

#: Published formats of credentials (cloud and code-host keys, chat and payment tokens, JWTs, PEM bodies), and e-mail addresses.
FORMATS = (
    r"(?<![A-Za-z0-9])(?:A(?:KIA|SIA)[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{40}|glpat-[A-Za-z0-9_-]{20}"
    r"|xox[abprs]-[A-Za-z0-9-]{20}|[rs]k_live_[A-Za-z0-9]{16}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8}"
    r"|MI[IGH][A-Za-z0-9+/]{45})"
)
ADDRESS = r"^[A-Za-z0-9+_.=-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+\.?$"

_TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=@-")
_DIGIT = re.compile("[0-9]")
_REST = re.compile("[A-Za-z0-9+/_.=@-]*")
_SIGN = re.compile("=>|:=|[:=]")
_NAMED = re.compile(rf"(?i)(?:{'|'.join(NAMES)})\w{{0,20}}[\"']?\s?\Z")
#: An authorization's scheme is a word before the value.
_VALUE = re.compile(r"\s?[\"']?(?:(?i:bearer|basic|token)\s+[\"']?)?([^\s\"']{6,})")
_KNOWN = re.compile(FORMATS)
_WORD = re.compile(r"[^\W\d_]+")
_KINDS = 4
#: Where features() says whether a word before is a secret's name, the last one is, and whether the value is assigned.
NAMED, NAMED_LAST, ASSIGNED = (8 + _KINDS + _KINDS**2 + k for k in range(3))
#: What ``rule_label`` looks at, so that a forest fitted to it doesn't: it would only learn the rule again.
RULE_FEATURES = (NAMED, NAMED_LAST, ASSIGNED)


def candidates(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the candidates of the whole text, in characters; overlapping ones are joined."""
    text = text or ""
    spans, end = [], 0
    for m in _DIGIT.finditer(text):  # digits are rare, so runs are found from them
        if m.start() >= end:
            start, end = m.start(), _REST.match(text, m.end()).end()
            while start and text[start - 1] in _TOKEN:
                start -= 1
            if end - start >= 8:
                spans.append((start, end))
    for m in _SIGN.finditer(text):
        if _NAMED.search(text, max(0, m.start() - 48), m.start()) and (v := _VALUE.match(text, m.end())):
            spans.append(v.span(1))
    spans.sort()
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _covered(value: str, words: frozenset[str]) -> float:
    """The share of the characters that lie in dictionary words, the longest first from the left."""
    low, at, n = value.lower(), 0, 0
    while at < len(low):
        for size in range(min(12, len(low) - at), 2, -1):
            if low[at : at + size] in words:
                n, at = n + size, at + size
                break
        else:
            at += 1
    return n / max(1, len(low))


def features(text: str, start: int, end: int, path: str | None, words: frozenset[str]) -> list[float]:
    value = text[start:end]
    n, count = len(value), Counter(value)
    kinds = np.array([_kind(c) for c in value])
    share = np.bincount(kinds, minlength=_KINDS) / n
    moves = np.bincount(kinds[:-1] * _KINDS + kinds[1:], minlength=_KINDS**2) / max(1, n - 1)
    before, after = text[max(0, start - 60) : start], text[end : end + 40]
    names = [w.lower() for w in _WORD.findall(before)][-3:]
    place = (path or "").lower()
    return [
        math.log1p(n), len(count) / n, -sum(k / n * math.log2(k / n) for k in count.values()), float(re.fullmatch("[0-9a-fA-F]+", value) is not None),
        float(value.isdigit()), float("@" in value), float("." in value), _covered(value, words), *share.tolist(), *moves.tolist(),
        float(any(x in w for w in names for x in NAMES)), float(bool(names) and any(x in names[-1] for x in NAMES)), float(re.search(r"[:=]\s?[\"']?$", before) is not None),
        float(before[-1:] in ("'", '"')), float(after[:1] in ("'", '"')), float(before[-2:].strip().startswith(")")),
        float(any(x in place for x in PLACES)), zlib.crc32(place.encode("utf-8", "surrogatepass")) % 16 / 16, float(any(w.lower() in words for w in _WORD.findall(after)[:1])),
        float(_KNOWN.search(value) is not None),
    ]


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> list[str]:
    """The ``size`` words of three to twelve letters that the documents use most, over all of them; ties by the word."""
    words = docs.select(F.explode(F.split(F.lower(col(text)), r"[^\p{L}]+")).alias("w")).where("length(w) between 3 and 12")
    return [r.w for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size).collect()]


def find(docs: DataFrame, words: list[str], key: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """(doc_id, start, length, value, features) of every candidate.

    Null and empty texts and tables without rows have none; ``path`` may be absent
    or null; repeated rows have theirs each. Texts are scanned whole, in time that
    grows with their length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(words))  # DICTIONARY words
    place = col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, t, p in zip(*batch.columns):
                t, p = t.as_py(), p.as_py()
                rows += [(i.as_py(), a, b - a, t[a:b], features(t, a, b, p, shared.value)) for a, b in candidates(t)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["doc_id", "start", "length", "value", "features"]
            )

    return docs.select(col(key).cast("long"), col(text), place).mapInArrow(found, "doc_id long, start long, length long, value string, features array<double>")


@dataclass(frozen=True)
class Forest:
    """Spark's forest, and the features it was fitted without."""

    model: RandomForestClassificationModel
    without: tuple[int, ...]


def _vector(without: Sequence[int]) -> Column:
    kept = F.filter("features", lambda x, i: ~i.isin(list(without))) if without else F.col("features")
    return array_to_vector(kept)


def learn(
    findings: DataFrame, label: str = "label", max_rows: int = MAX_ROWS, trees: int = 20, depth: int = 6, seed: int = 5, without: Sequence[int] = ()
) -> Forest | None:
    """A forest over (features, label). None without findings of both labels.

    ``without`` lists features that the labels were made from. Repeated findings
    count as often as they come.

    At most ``max_rows`` are used, picked by hash within each label: a label has
    half of them, or all its findings, and what the other leaves. Null labels are left out.
    """
    order = [F.xxhash64("doc_id", "start", "value"), F.col("doc_id"), F.col("start")]
    rows = findings.select("doc_id", "start", "value", "features", col(label).cast("double").alias("label"))
    picked = [written(rows.where(of).orderBy(*order).limit(max_rows), "secret-findings") for of in (F.col("label") > 0, F.col("label") <= 0)]
    n = [df.count() for df in picked]
    if not all(n):
        return None
    share = [max(max_rows - n[1], max_rows // 2), max(max_rows - n[0], max_rows - max_rows // 2)]
    some = [df.orderBy(*order).limit(k).select("features", "label") for df, k in zip(picked, share)]
    some = written(some[0].unionByName(some[1]), "secret-sample")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="x", labelCol="label")
    return Forest(forest.fit(some.select(_vector(without).alias("x"), "label")), tuple(without))


def judge(findings: DataFrame, forest: Forest | None) -> DataFrame:
    """``findings`` with score, 0 to 1, and secret (score of 0.5 or more).

    The forest removes false positives; a value in a known token format isn't one,
    whatever it says: score 1. Without a forest nothing is dropped. Without
    findings the result is empty.
    """
    if forest is None:
        return findings.withColumns({"score": F.lit(1.0), "secret": F.lit(True)})
    out = forest.model.transform(findings.withColumn("x", _vector(forest.without)))
    found = F.round(vector_to_array("probability")[1], 9)
    score: Column = F.when(F.col("value").rlike(FORMATS), F.lit(1.0)).otherwise(found)
    return out.select(*findings.columns, score.alias("score")).withColumn("secret", F.col("score") >= 0.5)


def rule_label() -> Column:
    """A label for findings nobody has looked at; null where the rule can't tell.

    Secrets are values in a known token format and long values with letters and
    digits in them that are assigned to a secret's name. Not secrets are e-mail
    addresses, and, away from such a name, values of one kind or too short for a
    token. A long mixed value without a name may be either.
    """
    near = F.col("features")[NAMED] == 1
    assigned = near & (F.col("features")[ASSIGNED] == 1)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    long = F.col("length") >= 16
    return (
        F.when(F.col("value").rlike(FORMATS), F.lit(True))
        .when(F.col("value").rlike(ADDRESS), F.lit(False))
        .when(assigned & mixed & long, F.lit(True))
        .when(~near & ~(mixed & long), F.lit(False))
    )
