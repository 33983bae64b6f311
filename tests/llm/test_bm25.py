import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from changeflow.llm import bm25


def brute(docs, queries, k):
    rows = [(d, bm25.terms_of(t)) for d, t in docs]
    mean = sum(sum(c.values()) for _, c in rows) / len(rows)
    df = Counter(w for _, c in rows for w in c)
    out = {}
    for q, text in queries:
        weights = {w: n * math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) for w, n in bm25.terms_of(text).items()}
        scores = []
        for d, c in rows:
            norm = bm25.K1 * (1 - bm25.B + bm25.B * sum(c.values()) / mean)
            s = sum(x * c[w] * (bm25.K1 + 1) / (c[w] + norm) for w, x in weights.items() if w in c)
            if s > 0:
                scores.append((-round(s, 6), d))
        out[q] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize("k, block", [(1, 2), (7, 100)])
def test_the_best_are_those_of_brute_force(spark, documents, monkeypatch, k, block):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {}
    for r in bm25.search(documents, documents.where("doc_id % 20 = 0"), k, query_block=block).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.doc_id))
    want = brute(rows, [x for x in rows if x[0] % 20 == 0], k)
    assert set(got) == {q for q, w in want.items() if w}
    for q, found in got.items():
        assert [d for *_, d in sorted(found)] == [d for _, d in want[q]]
        assert all(abs(a[1] + b[0]) < 2e-6 for a, b in zip(sorted(found), want[q]))


def test_odd_documents(spark, odd_docs, no_docs):
    got = bm25.search(odd_docs, odd_docs, 3).collect()
    assert {r.query_id for r in got} == {-3, 1, 2, 6, 7, 8, 9, 10}
    assert [r.doc_id for r in sorted((x for x in got if x.query_id == 6), key=lambda x: x["rank"])][:2] == [6, 7]
    assert bm25.search(no_docs, odd_docs, 3).count() == 0
    assert bm25.search(odd_docs, no_docs, 3).count() == 0


def test_queries_are_held_against_a_shard_together(monkeypatch):
    """The postings of a batch of queries are gathered at once, and only queries with a document over the floor are looked at alone."""
    draw = np.random.default_rng(3)
    docs = [Counter(draw.zipf(1.3, 80).clip(max=5000).tolist()) for _ in range(300)]
    shard = bm25._read_shard(bm25._shard(list(range(300)), docs), 0, 80.0)
    queries = [np.array(list(c)) for c in docs[:200]]
    weights = [draw.random(len(q)) + 0.1 for q in queries]
    whole = np.zeros((200, 300))
    for i, (q, w) in enumerate(zip(queries, weights)):
        for j, c in enumerate(docs):
            norm = bm25.K1 * (1 - bm25.B + bm25.B * 80 / 80.0)
            whole[i, j] = sum(x * c[t] * (bm25.K1 + 1) / (c[t] + norm) for t, x in zip(q.tolist(), w.tolist()) if t in c)
    calls, expand = [], bm25.Shard._expand
    monkeypatch.setattr(bm25.Shard, "_expand", staticmethod(lambda a, b: calls.append(1) or expand(a, b)))
    assert len(shard.dense) > 10 and (shard.column < 0).any()
    for floors in (np.zeros(200), np.sort(whole, axis=1)[:, -10] - 1e-9, whole.max(axis=1) + 1):
        calls.clear()
        got = {}
        for first, end, *terms in bm25._Queries(queries, weights).batches(shard):
            got |= {first + q: dict(zip(d.tolist(), s.tolist())) for q, d, s in shard.search(*terms, floors[first:end])}
        for i in range(200):
            want = {j: whole[i, j] for j in np.flatnonzero((whole[i] > 0) & (whole[i] >= floors[i])).tolist()}
            assert got.get(i, {}) == pytest.approx(want)
        assert len(calls) <= 2 * 4 + 200 * (floors[0] < whole[0].max())


def test_a_batch_is_scored_and_merged_at_once(monkeypatch):
    """Whatever the number of queries with documents over the floor, a batch takes one pass, in pieces of bounded size."""
    draw = np.random.default_rng(5)
    docs = [Counter(draw.zipf(1.3, 60).clip(max=3000).tolist()) for _ in range(200)]
    shards = [bm25._read_shard(bm25._shard(list(range(i, i + 100)), docs[i : i + 100]), 0, 60.0) for i in (100, 0)]
    queries = [np.array(list(c)) for c in docs[:150]]
    weights = [draw.random(len(q)) + 0.1 for q in queries]
    whole = np.array([[round(sum(x * c[t] * 2.2 / (c[t] + 1.2) for t, x in zip(q.tolist(), w.tolist())), 6) for c in docs] for q, w in zip(queries, weights)])
    calls, expand = [], bm25.Shard._expand
    monkeypatch.setattr(bm25.Shard, "_expand", staticmethod(lambda a, b: calls.append(1) or expand(a, b)))
    for terms, most in ((1 << 20, 3), (500, 10**9)):
        monkeypatch.setattr(bm25, "SCORED_TERMS", terms)
        best = bm25._Best(np.zeros(150), 4)
        for shard in shards:
            for first, end, *some in bm25._Queries(queries, weights).batches(shard):
                calls.clear()
                who, found, scores = shard.reaching(*some, best.floors[first:end])
                assert len(calls) <= most
                best.add(first, end, who, shard.ids[found], np.round(scores, 6))
        for q in range(150):
            want = sorted((-s, d) for d, s in enumerate(whole[q].tolist()) if s > 0)[:4]
            ids, scores = best.of(q)
            assert scores.tolist() == pytest.approx([-s for s, _ in want], abs=2e-6)
            assert ids.tolist() == [d for _, d in want]


def test_words_are_hashed_once_while_there_is_room(monkeypatch):
    bm25.worker_cache("another")
    monkeypatch.setattr(bm25, "CACHED_WORDS", 3)
    made = []
    digest = bm25.xxhash.xxh64_intdigest
    monkeypatch.setattr(bm25.xxhash, "xxh64_intdigest", lambda b: made.append(b) or digest(b))
    first, again = (bm25.terms_of("One, one (two) three ... --- four FOUR.") for _ in range(2))
    assert first == again and sorted(first.values()) == [1, 1, 1, 2, 2] and bm25.terms_of(None) == Counter()
    assert made.count(b"one") == 2 and made.count(b"two") == 1 and made.count(b"four") > 2
    bm25.worker_cache("another")


def test_blocks_that_can_not_reach_a_floor_are_not_multiplied():
    """Documents with the same common words are side by side, so a query reads few blocks of those that have others."""
    draw = np.random.default_rng(7)
    docs = [Counter((draw.zipf(1.2, n).clip(max=2000) * 2 + i % 2).tolist()) for i, n in enumerate(draw.integers(20, 200, 2048).tolist())]
    shard = bm25._read_shard(bm25._shard(list(range(5, 2053)), docs, True), 0, 100.0)
    assert sorted(shard.ids.tolist()) == list(range(5, 2053))

    class Tiles(list):
        read = 0

        def __getitem__(self, i):
            self.read += 1
            return list.__getitem__(self, i)

    assert len(shard.tiles) >= 16
    shard.tiles = Tiles(shard.tiles)
    for one in (0, 1):
        queries = [np.array(list(c)) for c in docs[one:60:2]]
        weights = [draw.random(len(q)) + 0.1 for q in queries]
        whole = np.array([[sum(x * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * c.total() / 100)) for t, x in zip(q.tolist(), w.tolist())) for c in docs] for q, w in zip(queries, weights)])
        floors = np.sort(whole, axis=1)[:, -10] - 1e-9
        shard.tiles.read = 0
        ((_, _, *terms),) = bm25._Queries(queries, weights).batches(shard)
        found, at, scores = shard.reaching(*terms, floors)
        assert 0 < shard.tiles.read <= len(shard.tiles) // 2 + bm25.GROUPS - 1 < len(shard.tiles)  # half of them, and where two groups meet
        for i in range(len(queries)):
            want = {d + 5: whole[i, d] for d in np.flatnonzero(whole[i] >= floors[i]).tolist()}
            assert dict(zip(shard.ids[at[found == i]].tolist(), scores[found == i].tolist())) == pytest.approx(want)
        found, at, scores = shard.reaching(*terms, floors * 0, 10)  # without a floor no more than the best get an exact score
        for i in range(len(queries)):
            assert 10 <= (found == i).sum() <= 12 and np.sort(scores[found == i])[-10:] == pytest.approx(np.sort(whole[i])[-10:])


def test_words_of_documents_are_those_of_queries():
    for text in (None, "", "... ---", "One, one (two) ONE \ud800x! 　ab\xa0c d.", "a a& &a b"):
        got = Counter()
        for term, n in zip(*(x.tolist() for x in bm25._counted(text))):
            got[term] += n
        assert got == bm25.terms_of(text)
    rows = [bm25._shard([1, 2, 3], d) for d in ([bm25._counted(t) for t in ("a a& b", "", "c &a")], [bm25.terms_of(t) for t in ("a a& b", "", "c &a")])]
    assert rows[0].equals(rows[1])


def test_floors_are_taken_from_the_largest_shard(spark):
    docs = [Counter({1: i % 5 + 1, 2 + i % 3: 1}) for i in range(60)]
    table = pa.Table.from_batches([bm25._shard([0], docs[:1]), bm25._shard(list(range(1, 60)), docs[1:]), bm25._shard([], [])])
    index = spark.createDataFrame(table).repartition(1)
    queries = spark.createDataFrame([(7, [1, 2], [0.5, 2.0]), (8, [4], [1.0]), (9, [99], [1.0])], "query_id long, terms array<bigint>, weights array<double>")
    ids, held, floors = bm25._with_floors(queries, index, 4.0, 10)
    found = dict(zip(ids.tolist(), floors.tolist()))
    assert held.count == 3 and found[7] > 0 and found[8] > 0 and found[9] == 0
    ids, held, floors = bm25._with_floors(queries.limit(0), index.limit(0), 0.0, 10)
    assert len(ids) == len(floors) == held.count == 0
