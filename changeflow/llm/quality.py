"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every feature i has a weight w_i and a vector v_i; a document x scores

    b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

and the pair sum is (|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2) / 2, so a score
takes time in proportion to the document's distinct words.

Features are made where the documents are. The model is fitted on at most
``max_rows`` labelled rows, picked by the hash of their id; that bound, and the
number of features, bound what the driver holds and what is broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm import codepoints as cp
from changeflow.llm.common import col, free, written

WORDS = 1 << 16
STEPS = 8
MAX_ROWS = 12_000
_CACHED = 300_000

STATISTICS = (
    "length", "words", "word_length", "distinct_words", "letters", "upper", "digits", "marks", "other", "space",
    "words_ending_in_marks", "lines", "distinct_lines", "line_length", "commonest_word", "declared_length",
)
FEATURES = WORDS + len(STATISTICS) * (STEPS + 1)
_hashed: dict[str, int] = {}


def _word(w: str) -> int:
    found = _hashed.get(w)
    if found is None:
        if len(_hashed) > _CACHED:
            _hashed.clear()
        found = _hashed[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORDS
    return found


def statistics(text: str, words: list[str], counts: Counter, n_chars: int | None) -> list[float]:
    """Structure of the whole text, and its declared length against its own; each from 0 to 1."""
    n, w = max(1, len(text)), max(1, len(words))
    kinds = np.bincount(cp.classes()[cp.points(text)], minlength=6) / n
    lines = text.split("\n")
    log = lambda x: min(1.0, math.log1p(x) / 14)
    marked = sum(k for word, k in counts.items() if not word[-1].isalnum())
    return [
        log(len(text)), log(len(words)), min(1.0, len(text) / w / 20), len(counts) / w, kinds[cp.LOWER] + kinds[cp.UPPER], kinds[cp.UPPER],
        kinds[cp.DIGIT], kinds[cp.MARK], kinds[cp.OTHER], kinds[cp.SPACE], marked / w, log(len(lines)), len(set(lines)) / len(lines),
        log(n / len(lines)), max(counts.values(), default=0) / w, 0.5 if n_chars is None else min(1.0, max(0, n_chars) / n / 2),
    ]


def features(text: str | None, n_chars: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values. A null text counts as empty, which has statistics and no words."""
    text = text or ""
    words = text.lower().split()
    counts = Counter(words)
    value: dict[int, float] = {}
    for w, k in counts.items():
        i = _word(w)
        value[i] = value.get(i, 0.0) + math.log1p(k)
    index = np.fromiter(value, np.int64, len(value))
    x = np.fromiter(value.values(), np.float64, len(value))
    x /= math.sqrt(float(x @ x)) or 1.0
    stats = np.array(statistics(text, words, counts, n_chars))
    base = WORDS + np.arange(len(stats)) * (STEPS + 1)
    step = np.minimum((stats * STEPS).astype(np.int64), STEPS - 1)  # the value itself, and the step it lies in
    return np.concatenate([index, base, base + 1 + step]), np.concatenate([x, stats, np.full(len(stats), 0.5)])


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, text: str | None, n_chars: int | None = None) -> float:
        i, x = features(text, n_chars)
        vx = self.vectors[i] * x[:, None]
        pairs = 0.5 * float((vx.sum(axis=0) ** 2).sum() - (vx**2).sum())
        z = self.bias + float(self.weights[i] @ x) + pairs
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, factors: int = 8, epochs: int = 6, rate: float = 0.08, batch: int = 128, decay: float = 1e-4, seed: int = 11) -> Machine:
    """Logistic loss, minibatches and AdaGrad. Without rows of both labels the score is the share of ones (a half for none)."""
    draw = np.random.default_rng(seed)
    share = (float(labels.sum()) + 1) / (len(labels) + 2)
    m = Machine(math.log(share / (1 - share)), np.zeros(FEATURES), draw.normal(0, 0.02, (FEATURES, factors)))
    if len(set(labels.tolist())) < 2:
        m.vectors[:] = 0
        return m
    gw, gv, gb = np.full(FEATURES, 1e-6), np.full((FEATURES, factors), 1e-6), 1e-6
    lengths = np.array([len(i) for i, _ in rows])
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            i = np.concatenate([rows[r][0] for r in some])
            x = np.concatenate([rows[r][1] for r in some])
            starts = np.concatenate([[0], np.cumsum(lengths[some])[:-1]])
            of = np.repeat(np.arange(len(some)), lengths[some])
            v = m.vectors[i]
            vx = v * x[:, None]
            s = np.add.reduceat(vx, starts)
            pairs = 0.5 * ((s**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), starts))
            z = m.bias + np.add.reduceat(m.weights[i] * x, starts) + pairs
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) / len(some)
            each = g[of] * x
            touched, where = np.unique(i, return_inverse=True)
            dw = np.bincount(where, each, len(touched)) + decay * m.weights[touched]
            dvx = each[:, None] * (s[of] - vx)
            dv = np.stack([np.bincount(where, dvx[:, k], len(touched)) for k in range(factors)], axis=1) + decay * m.vectors[touched]
            gw[touched] += dw**2
            gv[touched] += dv**2
            m.weights[touched] -= rate * dw / np.sqrt(gw[touched])
            m.vectors[touched] -= 0.3 * rate * dv / np.sqrt(gv[touched])
            gb += float(g.sum()) ** 2
            m.bias -= rate * float(g.sum()) / math.sqrt(gb)
    m.weights, m.vectors = m.weights.astype(np.float32), m.vectors.astype(np.float32)
    return m


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", label: str = "quality", max_rows: int = MAX_ROWS) -> Machine:
    """A machine fitted on at most ``max_rows`` of the labelled rows of ``docs``.

    Labels are 0 or 1; null ones are left out, and of several for an id the
    largest holds. Rows with a null id have no label.
    """
    known = labels.where(col(label).isNotNull() & col(key).isNotNull()).groupBy(col(key).alias("id")).agg(F.max(col(label)).alias("y"))
    known = known.join(docs.select(col(key).alias("id")).distinct(), "id", "left_semi")
    picked = written(known.orderBy(F.xxhash64("id"), "id").limit(max_rows), "quality-labels")
    declared = col(n_chars) if n_chars in docs.columns else F.lit(None)
    rows = docs.select(col(key).alias("id"), col(text).alias("text"), declared.cast("long").alias("n"))
    rows = rows.join(F.broadcast(picked), "id").select("id", "y", "text", "n")  # max_rows ids

    def made(batches):
        for b in batches:
            parts = [features(t.as_py(), n.as_py()) for t, n in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.string()), b.column(1).cast(pa.int32()), pa.array([i for i, _ in parts], pa.list_(pa.int32())), pa.array([x for _, x in parts], pa.list_(pa.float32()))],
                names=["id", "y", "i", "x"],
            )

    # One row for each picked id, whatever repeats there are.
    some = rows.mapInArrow(made, "id string, y int, i array<int>, x array<float>").dropDuplicates(["id"]).toArrow().sort_by("id")
    data = [(np.asarray(i.values, np.int64), np.asarray(x.values, np.float64)) for i, x in zip(some["i"], some["x"])]
    return fit(data, some["y"].to_numpy().astype(np.float64))


def classify(docs: DataFrame, machine: Machine, text: str = "text", n_chars: str | None = "n_chars", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with a score from 0 to 1 and predicted, 1 from 0.5 on. Columns of these two names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # FEATURES * (factors + 1) numbers
    mark, = free(docs, "judged")

    @F.arrow_udf("double")
    def judged(texts: pa.Array, declared: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array([m.score(t.as_py(), n.as_py()) for t, n in zip(texts, declared)], pa.float64())

    kept = [c for c in docs.columns if c.lower() not in (score.lower(), predicted.lower())]
    declared = (col(n_chars) if n_chars in docs.columns else F.lit(None)).cast("long")
    out = docs.withColumn(mark, judged(col(text), declared))
    return out.select(*(col(c) for c in kept), col(mark).alias(score), F.when(col(mark) >= 0.5, 1).otherwise(0).alias(predicted))
