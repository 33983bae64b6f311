import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from changeflow.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth string, x1 string, part string, size string, head string"
DATA = [None, "", "one two  three", "one two", "ü é", "a\nb\tc"]


def brute(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()
            conv[c].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in conv.items()}
    whole = {}
    for c, own in turns.items():
        other, taken = c - (abs(c) % 20) * (1 if c > 0 else -1), zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(turns.get(other, [])[:taken] + own[taken:])
    members, children, totals = defaultdict(list), defaultdict(list), {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    for path in sorted(members, key=len, reverse=True):
        below = [totals[x] for x in children[path]]
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        totals[path] = (sum(x for x, _ in below) or 1, (len(members[path]) - 1) * n_words + sum(x for _, x in below))
    out = set()
    for path, some in members.items():
        ends = ",".join(str(c) for c in sorted(some) if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.add((min(some), len(path), parent, len(some), len(children[path]), *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def built(spark, rows, **kw):
    df = spark.createDataFrame([(*r, *"xxxxxx") for r in rows], SCHEMA)
    out = T.trie(T.paths(df, T.shared_beginnings, most=3), **kw).drop("x1", "x2").collect()
    assert len(out) == len(set(out))
    return {tuple(r) for r in out}


def some_rows(seed, n=160):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 4 * n), n):
        rows += [(c, t if r.random() < 0.9 else None, r.choice(["user", "bot", None]), r.choice(DATA)) for t in range(r.randint(1, 7))]
    return rows + [(None, 1, "user", "no conversation")]


@pytest.mark.parametrize("kw", [{}, {"least_rows": 4, "band_bits": 0, "queue": 2}, {"least_rows": 4, "band_bits": 1, "queue": 3}])
def test_against_brute_force(spark, kw):
    rows = some_rows(1)
    assert built(spark, rows, **kw) == brute(rows)


def test_long_chain_and_hot_beginning(spark, monkeypatch):
    """One conversation holds a third of all turns, another third is copies; shards, bands and queue are small."""
    rows = [(40, t, "user", f"turn {t % 50}") for t in range(1, 401)]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(100) for t in range(4)]
    rows += some_rows(2, 100)
    monkeypatch.setattr(T, "ID_BITS", 3)
    want = brute(rows)
    assert built(spark, rows, least_rows=8, band_bits=3, queue=2) == want
    assert built(spark, rows) == want


def test_odd_rows(spark):
    assert built(spark, []) == set()
    assert built(spark, [(None, 1, "a", "b")]) == set()
    rows = [(5, None, None, None), (7, 1, "a", "long " * 50_000), (7, 1, "a", "long " * 50_000), (27, 1, "a", "b"), (27, 1, "a", "b"), (20, 3, "", ""), (-20, 3, "", "")]
    assert built(spark, rows) == brute(rows)


def test_queue_spills_and_keeps_the_order():
    r = random.Random(3)
    q, items, out = T.SpillingQueue(4), [(r.randint(0, 50), r.random()) for _ in range(500)], []
    for i, item in enumerate(items):
        q.push(item)
        assert len(q.heap) <= 4
        if i % 3 == 2:
            out.append(q.pop())
    assert len(q.runs) > 10
    rest = []
    while q.peek() is not None:
        assert q.peek() == (x := q.pop())
        rest.append(x)
    assert rest == sorted(rest) and sorted(out + rest) == sorted(items)
