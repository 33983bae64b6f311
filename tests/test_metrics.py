import random

import pytest
from helpers import at
from pyspark.sql import functions as F

from changeflow.operators import alerts, conservation, metrics, reconcile, slo


def outcomes(spark, rows):
    """rows: (second, result, dlq_reason, decision, latency_ms)"""
    df = spark.createDataFrame(
        [(at(s * 1000), r, d, c, lat) for s, r, d, c, lat in rows],
        "log_ts timestamp, result string, dlq_reason string, schema_decision string, latency_ms bigint",
    )
    return df.withColumn("commit_ts", F.col("log_ts"))


def quantile(spark, q, counts):
    total = counts[-1]
    row = spark.createDataFrame([tuple(counts)], [*metrics.LE, "latency_count"])
    assert total == counts[9]
    return row.select(metrics.histogram_quantile(q)).first()[0]


def test_histogram_quantile(spark):
    flat = [0, 0, 0, 0, 10, 10, 10, 10, 10, 10]
    assert quantile(spark, 0.5, flat) == pytest.approx(1.5)
    assert quantile(spark, 0.5, [10] * 10) == pytest.approx(0.05)
    assert quantile(spark, 0.99, [0] * 9 + [4]) == 30.0
    assert quantile(spark, 0.5, [0] * 10) is None


def test_counts_and_histogram(spark):
    df = outcomes(spark, [(0, "applied", None, "compatible", 90), (1, "applied", None, "conditional", 40_000),
                          (2, "skipped", None, "conditional", None), (3, "dlq", "decode_error", None, None)])
    assert {r.result: r.events for r in metrics.outcome_counts(df).collect()} == {
        "received": 4, "applied": 2, "skipped": 1, "dlq": 1,
    }
    rows = {r.le: r for r in metrics.latency_histogram(df).collect()}
    assert rows["0.1"].events == 1 and rows["30.0"].events == 1 and rows["+Inf"].events == 2
    assert rows["+Inf"].latency_sum == 40.09 and rows["+Inf"].latency_count == 2
    grid = metrics.fill_grid(metrics.bucketize(df))
    assert [r.warnings for r in metrics.schema_warning_count(grid).collect()] == [2]
    assert [(r.reason, r.events) for r in metrics.dlq_by_reason(grid).collect()] == [("decode_error", 1)]


def test_dead_letters_of_the_last_hour_by_reason(spark):
    df = outcomes(spark, [(t, "dlq", r, None, None) for t, r in ((0, "decode_error"), (1800, "decode_error"), (3590, "missing_required"), (5400, None))])
    got = {(r.eval_ts, r.reason): r.events for r in metrics.dlq_by_reason(metrics.fill_grid(metrics.bucketize(df))).collect()}
    first = min(t for t, _ in got)
    assert got[(first + 1800, "decode_error")] == 2 and got[(first + 3600, "decode_error")] == 1
    assert got[(first + 3585, "missing_required")] == 1 and (first + 5400, "decode_error") not in got


def test_two_reasons_below_the_limit_do_not_add_up(spark):
    def firing(*reasons):
        rows = [(i / 6, "dlq", r, None, None) for r in reasons for i in range(0, 720 * 6)] + [(0, "applied", None, None, 5)]
        grid = metrics.fill_grid(metrics.bucketize(outcomes(spark, rows)))
        lag = grid.select("bucket", F.lit(0).alias("consumer_lag"))
        rule = [r for r in alerts.shipped_rules() if r.name == "InventoryDLQSpike"]
        return alerts.alert_rules(alerts.signals(grid, lag, F.lit(0)), rule).filter("firing").count() > 0

    assert not firing("decode_error", "missing_required")
    assert firing("decode_error", "decode_error")


@pytest.mark.parametrize("when", ["0002-01-01 00:00:00", "1970-01-01 00:00:00", "9999-01-01 00:00:00"])
def test_a_far_commit_time_stays_in_the_grid(spark, when):
    df = outcomes(spark, [(i, "applied", None, None, 5) for i in range(0, 120, 5)])
    odd = F.when(F.second("log_ts") == 30, F.lit(when).cast("timestamp")).otherwise(F.col("log_ts"))
    df = df.withColumn("commit_ts", odd)
    seconds = F.floor(F.unix_millis("commit_ts") / 1000).cast("bigint")
    out = alerts.backlog(df, seconds, metrics.log_seconds()).orderBy("bucket").collect()
    assert len(out) == 8 and sum(r.outside for r in out) == 2 and out[-1].consumer_lag == 0


def test_rolling_sums_cross_slices(spark, monkeypatch):
    monkeypatch.setattr(metrics, "SLICE_SECONDS", 90)
    rng = random.Random(7)
    values = [rng.randrange(5) for _ in range(100)]
    grid = spark.createDataFrame([(1000 * 15 + i * 15, v) for i, v in enumerate(values)], "bucket bigint, x bigint")
    out = metrics.rolling(grid, {"a": ("x", 60), "b": ("x", 300)}).orderBy("bucket").collect()
    assert len(out) == 100
    assert [r.a for r in out] == [sum(values[max(0, i - 3): i + 1]) for i in range(100)]
    assert [r.b for r in out] == [sum(values[max(0, i - 19): i + 1]) for i in range(100)]


def test_grid_is_filled(spark):
    df = outcomes(spark, [(0, "applied", None, None, 5), (61, "applied", None, None, 5)])
    grid = metrics.fill_grid(metrics.bucketize(df)).orderBy("bucket").collect()
    assert [r.applied for r in grid] == [1, 0, 0, 0, 1]
    rate = metrics.event_rate(metrics.fill_grid(metrics.bucketize(df))).orderBy("eval_ts").collect()
    assert [r.rate for r in rate] == [1 / 60, 1 / 60, 1 / 60, 1 / 60, 1 / 60]
    assert metrics.fill_grid(metrics.bucketize(df.filter("false"))).count() == 0


def test_success_rates(spark):
    df = outcomes(spark, [(0, "applied", None, None, 5)] * 600 + [(0, "rejected", None, None, None)] * 200)
    r = metrics.success_rate(metrics.fill_grid(metrics.bucketize(df))).first()
    assert r.slo_success_rate == 0.75 and r.panel_success_rate == pytest.approx(600 / 1600)
    few = metrics.success_rate(metrics.fill_grid(metrics.bucketize(outcomes(spark, [(0, "applied", None, None, 5)])))).first()
    assert few.panel_success_rate == pytest.approx(1 / 300)


def test_consumer_lag(spark):
    log = spark.createDataFrame([("t", 0, 0), ("t", 0, 9), ("t", 1, 4)], "topic string, partition int, offset bigint")
    lag = metrics.consumer_lag(log, log.filter("partition = 0 AND offset = 0"))
    assert {r.partition: r.lag for r in lag.collect()} == {0: 9, 1: 1}
    assert metrics.topic_lag(lag).first().lag == 10


def test_threshold_band(spark):
    row = spark.createDataFrame([(1.9, 2.0, 3.0, None)], "a double, b double, c double, d double")
    got = row.select(*[metrics.threshold_band(F.col(c), 2, 3) for c in "abcd"]).first()
    assert list(got) == ["green", "yellow", "red", None]


def test_alert_fires_after_its_hold_and_resets(spark):
    active = [1, 1, 0, 1, 1, 1, 1, 0, 1]
    rows = spark.createDataFrame([(i * 15, v) for i, v in enumerate(active)], "bucket bigint, x int")
    out = alerts.alert_rules(rows, [alerts.Rule("r", "page", 30, F.col("x") == 1)]).orderBy("eval_ts").collect()
    assert [r.active for r in out] == [bool(v) for v in active]
    assert [r.firing for r in out] == [False, False, False, False, False, True, True, False, False]


def test_shipped_rules(spark):
    names = [r.name for r in alerts.shipped_rules()]
    assert len(names) == 7 and len(set(names)) == 7
    df = outcomes(spark, [(i, "applied", None, None, 9000) for i in range(0, 900, 5)])
    grid = metrics.fill_grid(metrics.bucketize(df))
    lag = alerts.backlog(df, metrics.log_seconds(), metrics.log_seconds())
    out = alerts.alert_rules(alerts.signals(grid, lag, F.lit(101)))
    firing = {r.alert for r in out.filter("firing").collect()}
    assert firing == {"InventorySyncLatencySLOBurnFast", "InventoryReconciliationMismatchHigh"}


def test_slo_report_and_budget(spark):
    df = outcomes(spark, [(0, "applied", None, None, 900)] * 9999 + [(0, "dlq", "decode_error", None, None)])
    run = spark.createDataFrame([(2,)], "gauge bigint")
    report = {r.slo: r for r in slo.slo_report(df, run).collect()}
    assert report["successful_processing"].met and report["freshness_p95"].met
    assert report["mismatch_rate"].value == 0.002 and not report["mismatch_rate"].met
    budget = slo.error_budget(df).first()
    assert (budget.allowed, budget.consumed, budget.remaining) == (5.0, 1, 4.0)
    assert (budget.allowed_per_day, budget.allowed_per_window) == (5.0, 140.0)
    assert slo.slo_report(df, run.limit(0)).filter("slo = 'mismatch_rate'").first().value is None
    no_day = slo.error_budget(df.limit(0)).first()
    assert no_day.received == 0 and no_day.allowed_per_day is None


def test_burn_needs_both_windows(spark):
    rows = [(i, "applied", None, None, 5) for i in range(0, 3600, 15)]
    rows += [(i, "dlq", "decode_error", None, None) for i in range(3600, 3900, 15)]
    out = slo.burn_rate(metrics.fill_grid(metrics.bucketize(outcomes(spark, rows))))
    fast = out.filter("pair = 'fast'").orderBy("eval_ts").collect()
    assert not any(r.firing for r in fast[:240]) and fast[-1].firing
    assert fast[-1].short_burn == pytest.approx(1 / 0.0005)


def test_severity(spark):
    def level(**kw):
        signals = dict(halted=False, critical_mismatch=False, latency_high=False, dlq_last_5m=0, lag_high=False,
                       schema_warnings=0, burn=0.0)
        signals.update(kw)
        return spark.range(1).select(slo.severity_triage(**{k: F.lit(v) for k, v in signals.items()})).first()[0]

    assert level() is None
    assert level(schema_warnings=1) == "SEV-3" and level(burn=3.5) == "SEV-3" and level(burn=None) is None
    assert level(dlq_last_5m=51, burn=9.0) == "SEV-2" and level(dlq_last_5m=50) is None
    assert level(halted=True, lag_high=True) == "SEV-1"
    assert level(overselling=True) == "SEV-1" and level(overselling=None) is None


def test_registered_metrics_on_the_log_s_own_clock(spark, small_dir):
    """A step of 15 s is 15 s of the log, over the whole log."""
    from changeflow.plans import queries as Q

    found = Q.registered()
    seconds = Q.outcomes(spark, small_dir).select(F.min(metrics.log_seconds()), F.max(metrics.log_seconds())).first()
    lo, hi = (v // 15 * 15 for v in seconds)
    for name in ("m4_event_rate", "m7_lag_series", "m13_threshold_band", "m14_severity_triage"):
        steps = found[name](spark, small_dir).agg(F.count("*"), F.min("eval_ts"), F.max("eval_ts")).first()
        assert tuple(steps) == ((hi - lo) // 15 + 1, lo + 15, hi + 15)


def test_overselling_alone_raises_sev_1(spark, small_dir):
    """Steps that only the clamps make SEV-1 are less severe once the clamps' limit is out of reach."""
    from changeflow.plans import queries as Q

    with_clamps = Q.severity(spark, small_dir, clamp_limit=0).withColumnRenamed("severity", "a")
    without = Q.severity(spark, small_dir, clamp_limit=10**9).withColumnRenamed("severity", "b")
    both = with_clamps.join(without, "eval_ts")
    assert both.filter("a = 'SEV-1' AND b IS DISTINCT FROM 'SEV-1'").count() > 0
    assert both.filter("a IS DISTINCT FROM b AND a <> 'SEV-1'").count() == 0


def lag_by_hand(log, commits, steps, step=15):
    out = {}
    for b in steps:
        total = {}
        for (topic, part) in {r[:2] for r in log}:
            mine = lambda rows: [o for t, p, o, s in rows if (t, p) == (topic, part) and s // step * step <= b]
            start = min(o for t, p, o, _ in log if (t, p) == (topic, part)) - 1
            total[topic] = total.get(topic, 0) + max([start, *mine(log)]) - max([start, *mine(commits)])
        out.update({(t, b): v for t, v in total.items()})
    return out


def test_lag_is_carried_forward(spark, monkeypatch):
    monkeypatch.setattr(metrics, "SLICE_SECONDS", 90)
    rng = random.Random(9)
    log = [("t" if p < 3 else "u", p, 10 * p + i, rng.randrange(0, 900) if p < 4 else 40) for p in range(5) for i in range(30)]
    log = sorted((t, p, o, s) for (t, p, _, s), (_, _, o, _) in zip(sorted(log, key=lambda r: (r[1], r[3])), sorted(log, key=lambda r: (r[1], r[2]))))
    commits = [(t, p, o, s + rng.randrange(300)) for t, p, o, s in log if p != 2 and not (p == 1 and s > 300) and rng.random() < 0.4]
    schema = "topic string, partition int, offset bigint, s bigint"
    frames = [
        spark.createDataFrame(rows, schema).withColumn("timestamp", F.timestamp_seconds("s")).drop("s") for rows in (log, commits)
    ]
    grid = spark.createDataFrame([(b,) for b in range(30, 840, 15)], "bucket bigint")
    got = {(r.topic, r.bucket): r.lag for r in metrics.lag_series(*frames, grid).collect()}
    assert got == lag_by_hand(log, commits, range(30, 840, 15))
    worst = {r.bucket: r.consumer_lag for r in alerts.worst_lag(metrics.lag_series(*frames, grid)).collect()}
    assert worst == {b: max(v for (_, at_), v in got.items() if at_ == b) for b in range(30, 840, 15)}
    none = metrics.lag_series(frames[0], frames[1].limit(0), grid).filter("topic = 't' AND bucket = 825").first()
    assert none.lag == lag_by_hand(log, [], [825])[("t", 825)]


def test_rollups_merge_and_windows_of_days(spark):
    rng = random.Random(11)
    df = outcomes(spark, [(rng.randrange(0, 40 * 86400), rng.choice(["applied", "dlq"]), None, None, None) for _ in range(2000)])
    df = df.withColumn("latency_ms", F.when(F.col("result") == "applied", F.unix_seconds("log_ts") % 9000))
    fine = metrics.bucketize(df)
    days = metrics.fill_grid(metrics.rollup(metrics.rollup(fine, 3600), slo.DAY), slo.DAY)
    direct = metrics.fill_grid(metrics.bucketize(df, step=slo.DAY), slo.DAY)
    assert sorted(days.collect()) == sorted(direct.collect())
    rows = {r.bucket: r for r in days.collect()}
    for r in slo.daily_budget(days).collect():
        end = r.eval_ts - slo.DAY
        window = [rows[b] for b in range(end - 27 * slo.DAY, end + 1, slo.DAY) if b in rows]
        received, applied = sum(w.received for w in window), sum(w.applied for w in window)
        assert (r.received_window, r.consumed_window, r.consumed_day) == (received, received - applied, rows[end].received - rows[end].applied)
    first = min(rows)
    runs = spark.createDataFrame([(first + 5, 4, 0), (first + 9, 1, 0), (first + 5 * slo.DAY, 7, 0)], "s bigint, mismatches bigint, critical_mismatches bigint")
    report = slo.daily_objectives(days, runs.withColumn("run_at", F.timestamp_seconds("s")))
    rate = {r.eval_ts: r.value for r in report.filter("slo = 'mismatch_rate'").collect()}
    assert len(rate) == len(rows) and {k: v for k, v in rate.items() if v is not None} == {first + slo.DAY: 0.001, first + 6 * slo.DAY: 0.007}


def test_conservation_finds_planted_gaps(spark):
    results = ["applied", "skipped", "rejected", "dlq"]
    lost = {("t", 0): {0, 1, 7, 99, 100, 101, 250, 999}, ("t", 1): set(), ("u", 0): set(range(40, 60))}
    rows = [(t, p, o, results[o % 4]) for (t, p), gone in lost.items() for o in range(1000) if o not in gone]
    rows += [("t", 1, 5, "applied"), ("t", 1, 6, results[6 % 4])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, result string")
    ends = spark.createDataFrame([(t, p, 0, 999) for t, p in lost] + [("u", 9, 3, 8)], "topic string, partition int, first_offset bigint, end_offset bigint")
    for size in (10**6, 100, 7):
        gaps = {(r.topic, r.partition, r.from_offset, r.to_offset): r.missing for r in conservation.offset_gaps(df, ends, size).collect()}
        assert gaps == {
            ("t", 0, 0, 1): 2, ("t", 0, 7, 7): 1, ("t", 0, 99, 101): 3, ("t", 0, 250, 250): 1, ("t", 0, 999, 999): 1,
            ("u", 0, 40, 59): 20, ("u", 9, 3, 8): 6,
        }
    found = {(r.topic, r.partition): r for r in conservation.conservation(df, ends, results, 100).collect()}
    assert {k: (r.expected, r.accounted, r.missing, r.repeated, r.conflicting, r.received, r.conserved) for k, r in found.items()} == {
        ("t", 0): (1000, 992, 8, 0, 0, 992, False), ("t", 1): (1000, 1000, 0, 2, 1, 1002, False),
        ("u", 0): (1000, 980, 20, 0, 0, 980, False), ("u", 9): (6, 0, 6, 0, 0, 0, False),
    }
    loss = conservation.no_silent_loss(conservation.conservation(df, ends, results)).first()
    assert (loss.value, loss.met) == (34.0, False)
    assert [(r.offset, r.deliveries, r.results) for r in conservation.repeated_offsets(df).orderBy("offset").collect()] == [(5, 2, 2), (6, 2, 1)]
    whole = df.filter("topic = 't' AND partition = 1").dropDuplicates(["offset"])
    assert conservation.conservation(whole, ends.filter("topic = 't' AND partition = 1"), results).first().conserved
    assert conservation.offset_gaps(df.limit(0)).count() == 0


def test_gauge_of_the_last_run_and_holds(spark):
    grid = spark.createDataFrame([(i * 15,) for i in range(60)], "bucket bigint")
    base = 1704067200
    stamps = [(at(s * 1000), n, n // 2) for s, n in ((70, 4), (75, 6), (300, 0))]
    runs = spark.createDataFrame(stamps, "run_at timestamp, mismatches bigint, critical_mismatches bigint")
    grid = grid.select((F.col("bucket") + base).alias("bucket"))
    got = {r.bucket - base: (r.mismatches, r.critical_mismatches) for r in alerts.latest_run(grid, runs).collect()}
    want = {b: (6, 3) if b + 15 < 300 else (0, 0) for b in range(60, 900, 15)}
    assert got == want
    rows = grid.select("bucket", ((F.col("bucket") - base) % 700 != 0).alias("x"))
    flags = alerts.held(rows, {"high": (F.col("x"), 600)}).orderBy("bucket").collect()
    assert [r.bucket - base for r in flags if r.high] == list(range(615, 900, 15))


def test_run_summary_counts_critical_products(spark):
    wrong = spark.createDataFrame([("a",), ("a",), ("b",)], "product_id string")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert tuple(reconcile.run_summary(wrong, at, ["a"]).first())[1:] == (3, 2)
    assert tuple(reconcile.run_summary(wrong.limit(0), at, ["a"]).first())[1:] == (0, 0)
