import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.llm import languages as L


def plain(text):
    """N-grams with loops: one to three characters of each word with a space at either end."""
    out = Counter()
    for w in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
        w = f" {w} "
        out.update(w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i : i + n] != " ")
    return out


@given(st.text(alphabet="ab Éßzπ.1-\n漢", max_size=40), st.sampled_from([4, 1 << 18]))
@settings(max_examples=150, deadline=None)
def test_ngrams(text, cut):
    kept, L._SLICE = L._SLICE, cut
    try:
        codes, counts = L.grams(text)
    finally:
        L._SLICE = kept
    spell = lambda c: "".join(chr(x) for x in (c >> 42, c >> 21 & 0x1FFFFF, c & 0x1FFFFF) if x)
    assert {spell(int(c)): int(n) for c, n in zip(codes, counts)} == dict(plain(text))


def test_distance_by_hand():
    a = L.profile(np.array([5, 6, 7], np.uint64), np.array([1, 9, 1]), 3)
    assert a.tolist() == [6, 5, 7]


def code(gram):
    return sum(ord(c) << (42 - 21 * i) for i, c in enumerate(gram))


def brute(train, texts, size=L.PROFILE):
    """Profiles by loops, and for each text the language at the least out-of-place distance."""
    ranked = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:size]]
    counts = {}
    for text, lang in train:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(plain(text))
    profiles = {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in counts.items() if c}
    out = []
    for text in texts:
        own = ranked(plain(text or ""))
        away = {lang: sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own)) for lang, p in sorted(profiles.items())}
        best = min(away, key=lambda lang: (away[lang], lang), default=None) if own else None
        out.append((L.UNKNOWN, 0.0) if best is None else (best, 1 - away[best] / (size * len(own))))
    return out


@pytest.mark.parametrize("size", [20, L.PROFILE])
def test_distances_are_those_of_loops(spark, documents, size):
    rows = documents.select("doc_id", "text", "lang").collect()
    train = [r for r in rows if r.doc_id % 3]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(documents, L.learn(documents.where("doc_id % 3 <> 0"), size=size)).collect()}
    for r, (lang, score) in zip(rows, brute([(t.text, t.lang) for t in train], [r.text for r in rows], size)):
        assert got[r.doc_id][0] == lang and abs(got[r.doc_id][1] - score) < 1e-12


def test_held_out_accuracy(spark, documents):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = L.identify(documents.where(held), L.learn(documents.where(~held))).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_documents(spark, odd_docs, no_docs):
    p = L.learn(odd_docs)
    assert p.languages == ["de", "en", "fr"]
    got = L.identify(odd_docs, p)
    assert got.count() == odd_docs.count() and set(got.columns) == set(odd_docs.columns)
    for r in got.collect():
        assert (r.lang_pred == "und" and r.score == 0) == (r.text is None or not any(c.isalpha() for c in r.text))
    none = L.learn(no_docs)
    assert {r.lang_pred for r in L.identify(odd_docs, none).collect()} == {"und"}
    assert L.identify(no_docs, p).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([("ab", str(i)) for i in range(5)], "text string, lang string")
    with pytest.raises(ValueError):
        L.learn(docs)
