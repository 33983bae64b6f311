from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from changeflow.llm import mixture as M


def fill(sizes, weights, cap=3):
    """Shares by weight, cut at the cap, the excess shared again, until none is above."""
    total, target, free = sum(sizes), [Fraction(0)] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(target[i] for i in range(len(sizes)) if i not in free)
        over = {i for i in free if left * weights[i] / Fraction(sum(weights[j] for j in free)) >= cap * sizes[i]}
        for i in free:
            target[i] = Fraction(cap * sizes[i]) if i in over else left * weights[i] / Fraction(sum(weights[j] for j in free))
        if not over:
            break
        free -= over
    return [float(t) for t in target]


@pytest.mark.parametrize("sizes", [[100, 10, 1], [1, 1, 1000, 5], [0, 0], [7], [0, 50, 3, 3, 900, 2, 2], [5, 1000, 1000, 1]])
def test_targets(spark, sizes):
    names = ["A", "a", "é", "𝒜", "b", "zz", "Z"][: len(sizes) - 1] + [None]
    rows = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long").withColumn("rows", F.lit(1))
    got = {r.source: r.target for r in M.targets(rows).collect()}
    order = sorted(range(len(names)), key=lambda i: (names[i] is None, names[i] or ""))
    want = fill([sizes[i] for i in order], [(5, 2, 1)[k % 3] for k in range(len(order))])
    for i, t in zip(order, want):
        assert got[names[i]] == pytest.approx(t)


def test_takes_come_near_their_targets_and_reruns_agree(spark, documents):
    got = M.taken(documents, bucket_rows=7).collect()
    assert sorted(got) == sorted(M.taken(documents.repartition(5)).collect())
    source = {r.doc_id: r.source for r in documents.collect()}
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.times * r["size"]
        by.setdefault(source[r.doc_id], []).append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r["size"] for r in rows) / 2
        assert max(r.times for r in rows) - min(r.times for r in rows) <= 1  # complete epochs first


def brute(rows, pattern=(5, 2, 1), cap=3):
    """How often each (doc, source, size, key) is taken: complete epochs, then the smallest keys until the rest runs out."""
    sources = sorted({r.source for r in rows}, key=lambda x: (x is None, x or ""))
    sizes = [sum(r["size"] for r in rows if r.source == x) for x in sources]
    times = {}
    for source, size, target in zip(sources, sizes, fill(sizes, [pattern[k % len(pattern)] for k in range(len(sources))], cap)):
        epochs = int(target // size) if size else 0
        rest, units = target - epochs * size, {}
        for r in rows:
            if r.source == source:
                units.setdefault(r.sample_key, []).append(r)
        reach, last = 0, None
        for key in sorted(units):
            unit = sum(r["size"] for r in units[key])
            if rest > 0 and reach < rest and reach + unit / 2 <= rest:
                last = key
            reach += unit
        for key, some in units.items():
            for r in some:
                times[r.doc] = epochs + (last is not None and key <= last)
    return times


def test_takes_are_those_of_a_plain_walk(spark, documents):
    rows = M.keyed(documents, "doc_id", "text", "source", 7).collect()
    for bucket_rows in (5, 4000):
        assert {r.doc_id: r.times for r in M.taken(documents, bucket_rows=bucket_rows).collect()} == brute(rows)


def test_smaller_keys_are_taken(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "'a b c d' as text", "if(id < 300, 'x', 'y') as source")
    keys = {r.doc: r.sample_key for r in M.keyed(docs, "doc_id", "text", "source", 7).collect()}
    rows = [r for r in M.taken(docs, bucket_rows=9).collect() if r.source_size == 1200]
    top = max(r.times for r in rows)
    assert max(keys[r.doc_id] for r in rows if r.times == top) < min(keys[r.doc_id] for r in rows if r.times < top)


def test_odd_documents(spark, odd_docs, no_docs):
    got = M.taken(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sum({r.source_size: r.target for r in got}.values()) == pytest.approx(sum(r["size"] for r in got))
    mixed = M.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(r.times for r in got)
    assert M.taken(no_docs).count() == 0 and M.mix(no_docs).count() == 0


def test_only_dataframe_functions(spark, documents):
    plan = M.mix(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
