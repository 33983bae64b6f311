import random

import pytest

from pyspark.sql import functions as F

from changeflow.operators import blocks, ledger


def loop(moves, opening):
    stock, out = dict(opening), {}
    for key, seq, delta in sorted(moves, key=lambda m: m[1]):
        if key in stock:
            qty, version = stock[key]
            after, version = max(0, qty + delta), version + 1
            absorbed = after - (qty + delta)
        else:
            after, version = max(0, 50 + delta), 1
            absorbed = after - (50 + delta)
        stock[key] = (after, version)
        out[seq] = (after, version, absorbed)
    return out


@pytest.mark.parametrize("seed, hot_rows", [(1, 10**6), (2, 20), (3, 1)])
def test_floor_ledger_equals_the_loop(spark, seed, hot_rows):
    rng = random.Random(seed)
    moves = [(rng.choice("AAAABCD"), i, rng.choice([-30, -20, -10, -3, 5, 15])) for i in range(300)]
    opening = {"B": (5, 7), "C": (0, 1)}
    df = spark.createDataFrame([(k, "W", i, d) for k, i, d in moves], "product_id string, warehouse_id string, seq bigint, delta bigint")
    start = spark.createDataFrame([(k, "W", q, v) for k, (q, v) in opening.items()], "product_id string, warehouse_id string, available_qty int, row_version bigint")
    out = ledger.floor_ledger(df, start, hot_rows=hot_rows)
    got = {r.seq: (r.on_hand, r.row_version, r.absorbed) for r in out.collect()}
    assert got == loop(moves, opening)
    clamps = {r.seq for r in ledger.negative_delta_clamps(out).collect()}
    assert clamps == {s for s, (_, _, a) in got.items() if a > 0} and clamps


def jobs_while(spark, build):
    sc = spark.sparkContext
    sc.setJobGroup("plan", "building a plan")
    try:
        out = build()
        return out, list(sc.statusTracker().getJobIdsForGroup("plan"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_while_a_plan_is_built_and_few_shuffles(spark, tmp_path):
    """Nine tenths of all rows in one key, in small blocks."""
    rows = [("A" if i % 10 else "B", "W", i, [-30, -20, 5, 15][i * 7 % 4]) for i in range(2000)]
    df = spark.createDataFrame(rows, "product_id string, warehouse_id string, seq bigint, delta bigint")
    df.write.parquet(str(tmp_path / "moves"))
    df = spark.read.parquet(str(tmp_path / "moves"))
    out, jobs = jobs_while(spark, lambda: ledger.floor_ledger(df, hot_rows=50))
    assert jobs == []
    got = {r.seq: (r.on_hand, r.row_version, r.absorbed) for r in out.collect()}
    assert got == loop([(p, s, d) for p, _, s, d in rows], {})
    run, jobs = jobs_while(spark, lambda: blocks.running(df, ["product_id"], "seq", {"total": ("sum", F.col("delta"))}, 50))
    assert jobs == []
    total, want = {}, {}
    for p, _, s, d in rows:
        total[p] = total.get(p, 0) + d
        want[s] = total[p]
    assert {r.seq: r.total for r in run.collect()} == want
    for frame in (out, run):
        # Exchanges that are reused are shuffled once.
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
        assert len(shuffled) <= 3, plan


def test_rows_stay_where_they_lie(spark, tmp_path):
    """Rows of a small file are joined with what their blocks inherit without being sent to every task."""
    spark.range(100).selectExpr("concat('A', id % 3) AS product_id", "concat('W', id % 2) AS warehouse_id", "id AS seq", "1L AS delta").write.parquet(str(tmp_path / "moves"))
    moves = spark.read.parquet(str(tmp_path / "moves"))
    for df in (ledger.floor_ledger(moves), blocks.running(moves, ["product_id"], "seq", {"total": ("sum", F.col("delta"))})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" in plan and "BuildLeft" not in plan
