import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeflow.llm import components as G
from changeflow.llm import similar as S
from changeflow.llm.common import written


def brute(rows, threshold=(90, 100), n=3):
    """(n_shingles, component_id) of each row, from all pairs."""
    p, q = threshold
    sets = [frozenset(S.shingles(t, n).tolist()) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and q * shared >= p * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str)


def near(draw, base, edits):
    words = list(base)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("threshold", [(90, 100), (80, 100)])
def test_components_are_those_of_all_pairs(spark, threshold):
    draw, rows = random.Random(4), []
    for size in (3, 9, 12, 20, 40, 150, 700):
        base = [f"w{draw.randrange(300)}" for _ in range(size)]
        rows += [near(draw, base, draw.choice((0, 0, 1, 1, 2, 3, size // 40, size // 25))) for _ in range(14)]
        rows += [" ".join(base[: size - draw.randrange(1 + size // 8)]) for _ in range(4)]
    rows = list(enumerate(rows))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.components(docs, threshold=threshold)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, threshold)


@given(st.integers(9, 400), st.integers(0, 10**6), st.booleans())
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_a_signature(size, seed, grow):
    """With as many differences as the threshold allows, spread at random."""
    draw = np.random.default_rng(seed)
    pool = np.unique(draw.integers(0, 2**63, 2 * size).astype(np.uint64))
    draw.shuffle(pool)
    a = np.sort(pool[:size])
    d = size // 9 if grow else 0
    b = np.sort(pool[: size + d]) if grow else np.sort(np.concatenate([pool[: size - size // 19], pool[size : size + size // 19 - (size % 19 == 0)]]))
    shared = len(np.intersect1d(a, b))
    if 100 * shared < 90 * (len(a) + len(b) - shared):
        return
    bands = S.Bands(90, 100)
    assert np.array_equal(a, b) or set(S.signatures(a, bands)) & set(S.signatures(b, bands))


def test_empty_segments_are_made_up_for(monkeypatch):
    """Sets that agree in empty segments only: one-deletion neighbourhoods find them."""
    found = 0
    bands, draw = S.Bands(90, 100), np.random.default_rng(3)
    for _ in range(4000):
        pool = draw.integers(0, 2**63, 24).astype(np.uint64)
        a, b = np.sort(pool[:20]), np.sort(pool[1:21]) if draw.random() < 0.5 else np.sort(pool[:22])
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 90 * (len(a) + len(b) - shared):
            found += 1
            assert set(S.signatures(a, bands)) & set(S.signatures(b, bands))
    assert found > 1000


@given(st.integers(9, 300), st.integers(0, 10**6))
@settings(max_examples=100, deadline=None)
def test_any_order_of_segments_will_do(size, seed):
    """Linked sets share a signature whatever the costs say, as long as both go by the same."""
    draw = np.random.default_rng(seed)
    pool = np.unique(draw.integers(0, 2**63, 2 * size).astype(np.uint64))
    draw.shuffle(pool)
    a, b = np.sort(pool[:size]), np.sort(np.r_[pool[: size - size // 20], pool[size : size + size // 25]])
    shared = len(np.intersect1d(a, b))
    if 100 * shared < 80 * (len(a) + len(b) - shared):
        return
    costs = {}
    for band, m in {*S.Bands(80, 100).schemes(len(a)), *S.Bands(80, 100).schemes(len(b))}:
        costs[band] = {int(k): int(draw.integers(1, 9)) for k in draw.integers(0, m, m)}
    bands = S.Bands(80, 100, costs=costs)
    assert np.array_equal(a, b) or set(S.signatures(a, bands)) & set(S.signatures(b, bands))


def test_packed_numbers_come_back():
    draw = np.random.default_rng(5)
    for bits, width in ((40, 5), (48, 6), (64, 8)):
        values = np.sort(draw.integers(0, 2 ** min(bits, 62), 1000).astype(np.uint64))
        assert np.array_equal(S._ascending(S._packed_ascending(values, width), width), values)
    docs = draw.integers(0, 2**31, 50).astype(np.uint64)
    assert np.array_equal(S._numbers(S._planes(docs, 4), 4), docs)


def test_repeated_keys(monkeypatch):
    monkeypatch.setattr(S, "CHUNK_KEYS", 60)
    draw, held, count = random.Random(6), S._Repeated(), {}
    for _ in range(30):
        keys = sorted(draw.sample(range(400), 20))
        held.add(np.array(keys, np.uint64))
        for k in keys:
            count[k] = count.get(k, 0) + 1
    every = np.arange(400, dtype=np.uint64)
    assert held.has(every).tolist() == [count.get(k, 0) > 1 for k in range(400)]


def test_sketches_never_show_more_differences():
    draw = np.random.default_rng(7)
    for size in (10, 300, 3000):
        pool = np.unique(draw.integers(0, 2**63, 2 * size).astype(np.uint64))
        a, b = pool[:size], pool[size // 5 : size + size // 9]
        x, y = (S.wide_sketch(s) for s in (a, b))
        to = min(len(x), len(y))
        fold = lambda s: np.bitwise_xor.reduce(s.reshape(-1, to), axis=0)
        differing = sum(int(v).bit_count() for v in (fold(x) ^ fold(y)).view(np.uint64))
        assert differing <= len(np.setxor1d(a, b))
        assert np.array_equal(fold(x), S.sketch(a, 64 * to))


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted(map(tuple, S.components(odd_docs).collect()), key=str)
    assert got == [(d, n, c if n else d) for d, n, c in brute(rows)]
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 6, 8, 9, None, None, 10, 10, -3], key=str)
    assert S.components(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0


def test_roots(spark):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(70)]
    top = {x: x for p in pairs for x in p}
    for _ in top:
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    links = spark.createDataFrame(pairs, "u long, v long")
    assert {r.node: r.root for r in G.roots(links).collect()} == {n: r for n, r in top.items() if n != r}
    assert G.roots(links.limit(0)).count() == 0


def test_keys_are_shuffled_once_and_held_in_a_file_if_many(spark, documents, monkeypatch):
    index = S._index(documents, "doc_id", "text", 3, (90, 100))
    index = written(index.where("range is not null"), "test-keys")
    want = Counter((r.key, r.chunk, r.at) for r in S._again(index).collect())
    assert want and all(n == 1 for n in want.values()) and min(Counter(k for k, *_ in want).values()) > 1
    monkeypatch.setattr(S, "HELD_BYTES", 100)
    found = S._again(index)
    assert Counter((r.key, r.chunk, r.at) for r in found.collect()) == want
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_entries_are_dealt_once(spark, documents, monkeypatch):
    plans, kept = {}, S.written

    def seen(df, name, **more):
        plans[name] = df._jdf.queryExecution().optimizedPlan()
        return kept(df, name, **more)

    def below(node):
        if node.nodeName().startswith("Repartition"):
            yield node
        for i in range(node.children().size()):
            yield from below(node.children().apply(i))

    monkeypatch.setattr(S, "written", seen)
    S.components(documents)
    first, *others = below(plans["similar-lists"])
    assert others and all(first.sameResult(x) for x in others)


def test_texts_stay_where_they_are_when_copies_go(spark, documents, monkeypatch):
    """However little Spark broadcasts by itself, the ids of documents that go, and of repeated ones, are sent to the texts."""
    draw = random.Random(8)
    rows = [(i % 40, " ".join(f"w{(i % 40) // 2 * 50 + k}" for k in range(30))) for i in range(60)] + [(90 + i, f"a{draw.random()} b") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = S.keep_one(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        found = sorted(kept.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 3
    assert found == sorted(set(r for r in rows if r[0] >= 90 or r[0] % 2 == 0))
