import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import hard_negatives as H
from changeflow.llm import tiles

EXTRA = "id string, v string, r string, group string, queries string, rows string, rank string, anchor string"
SCHEMA = f"vec_id long, vector array<long>, label int, {EXTRA}"


def brute(rows, positives=5, negatives=10):
    """The contract, one row at a time."""
    one = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and None not in v and sum(x * x for x in v) < H.LONGEST:
            one[i] = min(one.get(i, (label, v)), (label, v))
    wide = max([len(v) for _, v in one.values()], default=0)
    vectors = {i: np.array(v + [0] * (wide - len(v)), object) for i, (_, v) in one.items()}
    out = set()
    for a in [i for i in one if i % 10 == 0]:
        score = {i: int((vectors[a] * v).sum()) if wide else 0 for i, v in vectors.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if one[i][0] == one[a][0]][:positives]:
            fits = [i for i in order if one[i][0] != one[a][0] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out |= {(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fits[:negatives])}
    return out


def mined(spark, rows):
    df = spark.createDataFrame([(*r, *"xxxxxxxx") for r in rows], SCHEMA)
    out = H.mine(df, F.col("vec_id") % 10 == 0).collect()
    assert len(out) == len(set(out))
    return {tuple(r) for r in out}


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 33, 50), (64, 64, 64), (40, 7, 130), (3, 64, 200)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    r = np.random.default_rng(5)
    a, b = r.integers(-(2**27), 2**27, (m, k)), r.integers(-(2**27), 2**27, (k, n))
    for cut in (1, 3, 16):
        assert (H.strassen(a, b, cut) == a @ b).all()


def test_against_brute_force(spark, monkeypatch):
    r = random.Random(2)
    rows = [(i, [r.randint(-4, 5) for _ in range(6)], r.choice([0, 0, 0, 1, 2, 3])) for i in range(300)]
    want = brute(rows)
    assert len(want) > 500
    assert mined(spark, rows) == want
    monkeypatch.setattr(tiles, "GROUP", 20)
    monkeypatch.setattr(H, "TILE", 7)
    monkeypatch.setattr(H, "BLOCK", 4)
    assert mined(spark, rows) == want


def test_odd_rows(spark):
    r = random.Random(3)
    some = [(i, [r.randint(0, 3) for _ in range(3)], i % 3) for i in range(40)]
    odd = [
        (None, [1, 1, 1], 0), (50, None, 0), (60, [1, None, 2], 1), (70, [1, 2, 3], None), (80, [], 0), (90, [2], 1),
        (100, [2**40, 1, 1], 0), (110, [0, 0, 0], 2), (0, [9, 9, 9], 2), (0, [9, 9, 9], 2), (10, [0, 0, 1], 0), (-20, [3, 3, 3], -1), (41, [3, 3, 3], 2),
    ]
    assert mined(spark, some + odd) == brute(some + odd)
    assert mined(spark, [(i, [1, 1], i % 2) for i in range(50)]) == brute([(i, [1, 1], i % 2) for i in range(50)])
    assert mined(spark, []) == set()
    assert mined(spark, [(1, [1], 1), (2, [1], 2)]) == set()


def test_quantised(spark):
    rows = [([0.1, -0.1],), ([float("nan")],), ([None, 1.0],), (None,), ([],), ([1e30],), ([float("-inf")],)]
    df = spark.createDataFrame(rows, "e array<float>").select(H.quantised(F.col("e")).alias("v"))
    assert [x.v for x in df.collect()] == [[25, -26], None, None, None, [], None, None]
