import zlib

import numpy as np
import pytest

P = pytest.importorskip("corpus_pipeline")

from changeflow.llm import token_planes as T  # noqa: E402


def test_stages_over_the_small_tables(spark, small_dir, documents):
    """Each stage against a brute-force version of it, on what its predecessor kept."""
    import test_decontaminate
    import test_languages
    import test_mixture
    import test_similar

    docs, kept = documents, {}
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, small_dir), name)
        kept[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == documents.columns
            assert docs.distinct().exceptAll(documents.distinct()).count() == 0
    rows = lambda name: [(r.doc_id, r.text) for r in kept[name].collect()]

    given = documents.collect()
    judged = test_languages.brute([(r.text, r.lang) for r in given], [r.text for r in given])
    known = {r.doc_id for r, (lang, score) in zip(given, judged) if lang != "und" and score >= P.LEAST_LANGUAGE_SCORE}
    assert {d for d, _ in rows("language_id")} == known and len(known) >= 0.98 * len(given)

    one = test_similar.brute(rows("language_id"), P.NEAR_THRESHOLD, P.NEAR_WORDS)
    assert {d for d, _ in rows("ngram_jaccard_join")} == {d for d, _, c in one if d == c}

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    hits = test_decontaminate.brute(rows("ngram_jaccard_join"), bench)
    clean = {d for d, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}
    assert {d for d, _ in rows("benchmark_decontamination")} == clean

    from changeflow.llm import mixture

    times = test_mixture.brute(mixture.keyed(kept["benchmark_decontamination"], "doc_id", "text", "source", 7).collect())
    mixed = sorted(rows("source_mixture"))
    assert [d for d, _ in mixed] == [d for d in sorted(times) for _ in range(times[d])]

    tokenizer, start, want = T._encoder(None).tokenizer, 0, []
    for d, text in mixed:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, docs.collect())) == want


def test_stages_on_odd_and_empty_tables(spark, small_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES:
            docs = P.written(stage(spark, docs, small_dir), name)
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_near_copies_go_at_five_words_and_four_fifths(spark, small_dir, documents):
    words = [f"w{i}" for i in range(100)]
    near, far = list(words), list(words)
    near[30], near[60] = "a", "b"  # 5-word Jaccard 86/106, 3-word 92/104
    for i in (20, 40, 60):
        far[i] = f"c{i}"  # 81/111
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    first = max(d for d, _ in rows) + 1
    rows += [(first + i, " ".join(w)) for i, w in enumerate((words, near, far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in dict(P.STAGES)["ngram_jaccard_join"](spark, docs, small_dir).collect()}
    assert {first, first + 2} <= kept and first + 1 not in kept

    sets = {}
    for d, text in rows:
        w = text.lower().split()
        sets[d] = {tuple(w[i : i + min(5, len(w))]) for i in range(max(len(w) - 4, min(len(w), 1)))}
    component = {d: {d} for d, _ in rows}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                component[a] |= component[b]
                for d in component[a]:
                    component[d] = component[a]
    assert kept == {d for d in ids if d == min(component[d])}
