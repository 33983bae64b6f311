import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from changeflow.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Literals, a broadcast table, a shuffled join.
WAYS = [{}, {"literal_bytes": 0}, {"literal_bytes": 0, "broadcast_bytes": 0}]
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def test_short_items_overlaps_and_the_share(spark):
    bench = spark.createDataFrame([(1, ITEM, "x"), (2, "Short item!", "x"), (3, "", "x"), (4, None, "x"), (None, "tiny", "x"), (1, "copy of one", "x")], "item_id long, text string, gram string")
    filler = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame(
        [
            (1, f"a {ITEM.upper()} b"), (2, f"{filler} short, ITEM {filler}"), (3, "short-item short item"), (4, None), (5, ""), (6, filler),
            (7, ITEM.replace("mu", "my")), (8, "tiny"), (9, f"{ITEM} {ITEM}"),
        ],
        "doc_id long, text string",
    )
    want = {
        1: (17, 15, "1", True), 2: (802, 2, "2", False), 3: (4, 4, "2", True), 4: (0, 0, "", False), 5: (0, 0, "", False), 6: (400, 0, "", False),
        7: (15, 0, "", False), 8: (1, 1, "", True), 9: (30, 30, "1", True),
    }
    for way in WAYS:
        got = {r.doc_id: (r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in D.report(docs, bench, **way).collect()}
        assert got == want


@pytest.mark.parametrize("way", WAYS)
def test_odd_documents_and_empty_tables(spark, odd_docs, no_docs, way):
    bench = spark.createDataFrame([(1, "seven eight")], "item_id long, text string")
    kept = D.drop_contaminated(odd_docs, bench, **way)
    assert kept.columns == odd_docs.columns
    assert kept.exceptAll(odd_docs).count() == 0 and odd_docs.count() - kept.count() == 2
    assert D.drop_contaminated(no_docs, bench, **way).count() == 0
    assert D.drop_contaminated(odd_docs, bench.limit(0), **way).count() == odd_docs.count()
    assert D.report(odd_docs, bench, **way).count() == odd_docs.count()


def test_spans_are_cut(spark):
    bench = spark.createDataFrame([(1, "two three"), (2, "three four")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "(One) two, THREE-four! five"), (2, "two three"), (3, "kept as it is"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in D.cut_spans(docs, bench).collect()}
    assert got == {1: "(One) ! five", 2: "", 3: "kept as it is", 4: None}


def brute(docs, items, n=13):
    """(words, words hit, items) of each document, window by window."""
    norm = lambda t: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for item, text in items:
        w = norm(text)
        for i in range(len(w) - min(n, len(w)) + 1):
            if w:
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    want = {}
    for doc, text in docs:
        w, hit, found = norm(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        want[doc] = (len(w), len(hit), sorted(found))
    return want


def test_all_ways_agree_with_brute_force(spark, documents, small_dir):
    bench = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in bench.collect()])
    for way in WAYS:
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in D.report(documents, bench, **way).collect()}
        assert got == want


def test_only_dataframe_functions(spark, documents, small_dir):
    found = D.report(documents, spark.read.parquet(f"{small_dir}/benchmark.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert found.where(F.col("n_hit") > 0).count() > 0


def test_the_way_goes_by_bytes(spark, documents, small_dir):
    bench = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    plans = [D.report(documents, bench, **way)._jdf.queryExecution().executedPlan().toString() for way in WAYS]
    assert "LeftSemi" not in plans[0]
    assert re.search(r"BroadcastHashJoin \[hash#\d+L?\], \[hash#\d+L?\], LeftSemi", plans[1])
    assert re.search(r"SortMergeJoin \[hash#\d+L?\], \[hash#\d+L?\], LeftSemi", plans[2])


MANY = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from changeflow.llm import decontaminate as D
words = F.expr("transform(sequence(1, 40), k -> concat('w', id, 'x', k))")
bench = spark.range(7200).select(F.col("id").alias("item_id"), F.array_join(words, " ").alias("text"))
docs = spark.range(0, 7200, 90).select(F.col("id").alias("doc_id"), F.concat(F.lit("before it "), F.array_join(words, " ")).alias("text"))
out = D.report(docs, bench).collect()
print("windows", D.benchmark_windows(bench).count(), "right", sum(r.n_hit == 40 and r["items"] == [str(r.doc_id)] for r in out), len(out))
"""


def test_many_windows_on_a_small_heap(tmp_path):
    """200,000 windows and a driver of 750 MB, which is also the executor here."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--driver-memory 750m pyspark-shell", "SPARK_LOCAL_IP": "127.0.0.1"}
    run = subprocess.run([sys.executable, "-c", MANY.format(root=root)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "windows 201600 right 80 80" in run.stdout, run.stderr[-2000:]
