import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import neighbours as N
from changeflow.llm import tiles

SCHEMA = "vec_id long, embedding array<double>, id string, v string, query string, code string, rank string, score string"


def searched(spark, rows, every=10, **kw):
    df = spark.createDataFrame([(i, v, *"xxxxxx") for i, v in rows], SCHEMA)
    out = N.search(df, F.col("vec_id") % every == 0, **kw).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(by[r.query_id])
    return by


def exact(rows, every=10, most=20):
    one = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            one[i] = min(one.get(i, v), v)

    def score(a, b):
        total = 0.0
        for x, y in zip(a, b, strict=False):
            total += x * y
        return total

    return {
        q: sorted(((i, score(one[q], v)) for i, v in one.items() if i != q), key=lambda p: (-p[1], p[0]))[:most] for q in one if q % every == 0
    }


def recall(got, want):
    pairs = [(q, i) for q, found in want.items() for i, _ in found]
    return sum(i in {x for x, _ in got.get(q, [])} for q, i in pairs) / len(pairs)


@pytest.mark.parametrize("kind", ["spread", "clustered", "unequal lengths"])
def test_recall_and_scores(spark, kind, monkeypatch):
    monkeypatch.setattr(N, "BUCKET", 40)
    r = np.random.default_rng(4)
    v = r.standard_normal((1500, 16))
    if kind == "clustered":
        v = v * 0.2 + r.standard_normal((30, 16))[r.integers(0, 30, 1500)]
    if kind == "unequal lengths":
        v *= r.exponential(1, (1500, 1))
    rows = [(i, [float(x) for x in line]) for i, line in enumerate(v)]
    got, want = searched(spark, rows), exact(rows)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    assert recall(got, want) >= 0.9
    score = {q: dict(sorted(((i, s) for i, s in exact(rows, most=1500)[q]))) for q in list(got)[:10]}
    for q in score:
        assert all(score[q][i] == s for i, s in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))


def test_hot_bucket_is_whole(spark, monkeypatch):
    """A third of all rows are one vector: its bucket is cut into tiles in all groups, none is left out."""
    monkeypatch.setattr(N, "TILE", 16)
    monkeypatch.setattr(tiles, "GROUP", 64)
    monkeypatch.setattr(N, "BUCKET", 20)
    r = np.random.default_rng(6)
    same = [1.0] * 8
    rows = [(i, same if i % 3 == 0 else [float(x) for x in r.standard_normal(8)]) for i in range(600)]
    got, want = searched(spark, rows, every=30), exact(rows, every=30)
    assert got == want  # the copies come first, by id


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    some = [(i, [float(i % 7), 1.0, -float(i % 3)]) for i in range(60)]
    odd = [
        (None, [1.0]), (100, None), (110, []), (120, [0.0, 0.0]), (130, [None, 1.0]), (140, [nan, 1.0]), (150, [inf]), (160, [2.0]), (0, [5.0, 5.0, 5.0]),
        (0, [5.0, 5.0, 5.0]), (61, [1e150, 1.0, 1.0]),
    ]
    assert searched(spark, some + odd) == exact(some + odd)
    assert searched(spark, []) == {}
    assert searched(spark, [(1, [1.0])]) == {}
    assert searched(spark, [(10, [1.0])]) == {}
    assert searched(spark, [(10, [1.0]), (20, [2.0])]) == {10: [(20, 2.0)], 20: [(10, 2.0)]}


def test_given_table(spark, small_dir):
    from changeflow.llm.queries import op12_neighbours

    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    want = exact(rows, every=20)
    got = {q: [] for q in want}
    for r in op12_neighbours(spark, small_dir).collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert recall(got, want) >= 0.9
