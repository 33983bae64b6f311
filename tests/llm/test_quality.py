import math

import numpy as np
from pyspark.sql import functions as F

from changeflow.llm import quality as Q


def test_the_identity_equals_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    m = Q.Machine(0.3, draw.normal(size=Q.FEATURES), draw.normal(0, 0.2, (Q.FEATURES, 4)))
    i, x = Q.features("a few Words, and a number 7 \n", 20)
    z = 0.3 + float(m.weights[i] @ x) + sum(float(m.vectors[i[a]] @ m.vectors[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a))
    assert abs(m.score("a few Words, and a number 7 \n", 20) - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_held_out_accuracy(spark, documents, small_dir):
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    m = Q.learn(documents.where(~held), labels)
    got = Q.classify(documents.where(held), m).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_odd_documents_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (6, 1), (9, None), (None, 1), (99, 1), (10, 0)], "doc_id long, quality int")
    m = Q.learn(odd_docs, labels)
    got = Q.classify(odd_docs, m).collect()
    assert len(got) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert Q.classify(no_docs, m).count() == 0
    prior = Q.learn(no_docs, labels)
    assert {r.score for r in Q.classify(odd_docs, prior).collect()} == {0.5}


def test_the_bound_on_training_rows(spark, documents, small_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "fit", lambda rows, labels: seen.append(len(rows)))
    Q.learn(documents, spark.read.parquet(f"{small_dir}/labels.parquet"), max_rows=17)
    assert seen == [17]
