import datetime as dt
import glob
import json
import os
import re

import pytest
from helpers import at, gated_events, log_of, message
from pyspark.sql import functions as F

from changeflow import model, session
from changeflow.functions.decode import decode
from changeflow.operators import gates, readmodel, reconcile, replay, resolve
from changeflow.plans import queries
from changeflow.sinks.state import MarkTable, StateTable
from changeflow.sinks.tables import append_audit, audit_bytes, audit_day, dlq_messages, merge_into_table, read_audit, seed_missing, write_dlq
from changeflow.sources import log as L
from changeflow.sources import tables as S

NOW = dt.datetime(2024, 1, 2)
SEED = [
    ("KETTLE-7", "DEPOT-A", 41, 0, "ACTIVE", 61),
    ("KETTLE-7", "DEPOT-B", 19, 4, "ACTIVE", 46),
    ("MUG-3", "DEPOT-A", 82, 1, "ACTIVE", 37),
    ("LAMP-9", "DEPOT-A", 0, 0, "OOS", 205),
]


def source(spark, rows=SEED):
    return spark.createDataFrame(
        [(*r, NOW) for r in rows],
        "product_id string, warehouse_id string, available_qty int, reserved_qty int, stock_status string, "
        "row_version bigint, last_updated timestamp",
    )


def test_seed_then_reconcile_is_clean(spark):
    seeded = seed_missing(None, source(spark), F.lit(NOW))
    assert seeded.count() == 4
    assert {r.last_event_id for r in seeded.collect()} >= {"seed-KETTLE-7-DEPOT-A"}
    assert reconcile.mismatch_view(source(spark), seeded).count() == 0
    again = seed_missing(seeded.filter("stock_status <> 'OOS'"), source(spark), F.lit(NOW))
    assert again.count() == 4


def test_mismatch_reasons(spark):
    web = seed_missing(None, source(spark), F.lit(NOW)).filter("stock_status <> 'OOS'")
    web = web.withColumn(
        "row_version",
        F.when(F.col("warehouse_id") == "DEPOT-B", 52).when(F.col("product_id") == "MUG-3", 31).otherwise(F.col("row_version")),
    ).withColumn("available_qty", F.when(F.col("row_version") == 61, 40).otherwise(F.col("available_qty")))
    view = reconcile.mismatch_view(source(spark), web)
    reasons = {(r.product_id, r.warehouse_id): r.reason for r in view.collect()}
    assert reasons == {
        ("KETTLE-7", "DEPOT-A"): "value_mismatch",
        ("KETTLE-7", "DEPOT-B"): "website_ahead",
        ("MUG-3", "DEPOT-A"): "website_behind",
        ("LAMP-9", "DEPOT-A"): "missing_in_website",
    }
    assert reconcile.mismatch_gauge(view, 3).first() == (3, 4)
    assert reconcile.reconcile(source(spark), web, 2).count() == 2
    assert reconcile.reconcile(source(spark), web, 0).count() == 4
    assert reconcile.replay_window(view, web).first() == (NOW, NOW)
    missing = [r for r in view.collect() if r.reason == "missing_in_website"][0]
    assert missing.website_qty is None and missing.website_version is None


def test_snapshot_runs_ahead_of_the_log(spark):
    snapshot = S.snapshot_to_events(source(spark), F.lit(NOW))
    log = log_of(spark, [message("a", "LAMP-9", "DEPOT-A", 206, qty=9), message("b", "KETTLE-7", "DEPOT-B", 45)])
    gated = gates.gate(decode(snapshot.unionByName(log))).cache()
    results = {r.event_id: r.result for r in resolve.event_outcomes(gated).collect()}
    assert results == {"warehouse_inventory-0-0": "applied", "a": "applied", "b": "rejected"}
    state = {(r.product_id, r.warehouse_id): r.row_version for r in resolve.versioned_upsert(None, gated).collect()}
    assert state[("LAMP-9", "DEPOT-A")] == 206 and state[("KETTLE-7", "DEPOT-B")] == 46


def test_dead_letters_go_out_and_come_back(spark, tmp_path):
    gated = gates.gate(decode(log_of(spark, ["{bad", message("a", "P", "W", 1), message("b", "P", "W", 0)])))
    dead = gates.dlq_envelope(gates.route_dlq(gated)[1]).cache()
    write_dlq(dlq_messages(dead), str(tmp_path / "dlq"))
    sent = spark.read.parquet(str(tmp_path / "dlq")).orderBy("timestamp").collect()
    first = json.loads(sent[0].value)
    assert first["original_topic"] == "t" and first["raw_payload"] == "{bad" and "event_id" not in first
    assert {h.key: bytes(h.value).decode() for h in sent[0].headers} == {
        "x-dlq-reason": "decode_error", "x-original-topic": "t",
    }
    again = replay.replay_dlq(dead, F.lit(at(1)))
    assert [r.value for r in again.collect()] == [message("b", "P", "W", 0)]
    assert reconcile.dlq_investigate(dead, 1).count() == 2
    both = replay.first_failures(dead.unionByName(dead.withColumn("first_failed_at", F.lit(NOW))))
    assert {(r.original_offset, r.first_failed_at, r.deliveries) for r in both.collect()} == {(0, at(0), 2), (2, at(2), 2)}
    with pytest.raises(ValueError):
        write_dlq(dlq_messages(dead))


def test_audit_replay_is_idempotent(spark, tmp_path):
    gated = gates.gate(decode(log_of(spark, [message(f"e{i}", "P", "W", i + 1, when=f"2024-01-0{i + 1}T12:00:00Z") for i in range(5)])))
    root = str(tmp_path / "audit")
    append_audit(gated.filter("kafka_offset < 3"), root, 0)
    append_audit(gated.filter("kafka_offset >= 3"), root, 1)
    append_audit(gated.filter("kafka_offset >= 3"), root, 1)
    audit = read_audit(spark, root)
    assert audit.count() == 5
    back = replay.replay_from_audit(audit, F.lit(dt.datetime(2024, 1, 2, 12)), F.lit(dt.datetime(2024, 1, 4, 11)))
    assert sorted(r.offset for r in back.collect()) == [1, 2]
    assert replay.replay_count(back).first()[0] == 2
    scan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in scan
    labels = {r.result for r in resolve.event_outcomes(
        gates.gate(decode(back)), resolve.versioned_upsert(None, gated), resolve.mark_applied(resolve.event_outcomes(gated))
    ).collect()}
    assert labels == {"skipped"}


def test_audit_files_go_by_bytes(spark, tmp_path):
    log = log_of(spark, [message(f"e{i}", "P" * 50, "W", 1 + i) for i in range(2000)])
    day = F.when(F.col("offset") < 1900, "2024-01-05").otherwise(F.concat(F.lit("2024-01-0"), (F.col("offset") % 4 + 1).cast("string")))
    gated = gates.gate(decode(log.withColumn("timestamp", day.cast("timestamp")).repartition(16)))
    gated = gated.withColumn("commit_ts", F.col("log_ts")).cache()
    sizes = {str(r[0]): r[1] for r in gated.groupBy(audit_day()).agg(audit_bytes()).collect()}
    for target in (10**9, 150_000):
        root = str(tmp_path / f"audit{target}")
        append_audit(gated, root, 0, file_bytes=target)
        files = {d: len(glob.glob(f"{root}/batch_id=0/event_date={d}/*.parquet")) for d in sizes}
        assert sum(files.values()) <= len(sizes) + sum(sizes.values()) / target
        assert all(n <= -(-sizes[d] // target) for d, n in files.items())
        assert read_audit(spark, root).count() == 2000
    assert max(files.values()) > 2
    back = replay.replay_from_audit(read_audit(spark, root), F.lit(dt.datetime(2024, 1, 1)), F.lit(dt.datetime(2024, 1, 1, 23)))
    assert back.count() == 25 and "PartitionFilters: [isnotnull(event_date" in back._jdf.queryExecution().executedPlan().toString()


def versions(df):
    return {r.product_id: r.row_version for r in df.collect()}


def test_state_table(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), buckets=4)
    assert table.read().count() == 0
    first = gated_events(spark, [(i, f"a{i}", f"P{i}", "W", 1, 0) for i in range(20)])
    table.replace(0, resolve.versioned_upsert(None, first))
    second = gated_events(spark, [(30, "b", "P3", "W", 2, 5)])
    touched = table.touched(second)
    untouched = sorted(f for f in glob.glob(f"{table.table}/bucket=*/*.parquet") if f"bucket={touched[0]}/" not in f)
    for _ in range(2):
        table.replace(1, resolve.versioned_upsert(table.read(touched), second))
        rows = versions(table.read())
        assert len(rows) == 20 and rows["P3"] == 2 and rows["P4"] == 1
    # Files of other buckets are the same ones; copies of earlier batches are gone.
    assert set(untouched) <= set(glob.glob(f"{table.table}/bucket=*/*.parquet"))
    assert os.listdir(tmp_path / "s" / "staged") == ["batch=1"]
    scan = table.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scan
    with pytest.raises(ValueError):
        StateTable(spark, str(tmp_path / "s"), buckets=8).read()


def test_a_crash_between_stage_and_swap_loses_nothing(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), buckets=4)
    table.replace(0, resolve.versioned_upsert(None, gated_events(spark, [(i, f"a{i}", f"P{i}", "W", 1, 0) for i in range(20)])))
    events = gated_events(spark, [(20 + i, f"b{i}", f"P{i}", "W", 2, 5) for i in range(20)])
    table.stage(1, resolve.versioned_upsert(table.read(), events))
    assert set(versions(table.read()).values()) == {1}
    # A part of the swap had happened: the batch that runs again must not start from it.
    staged = spark.read.parquet(str(tmp_path / "s/staged/batch=1")).filter("bucket = 2")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(table.table)
    assert set(versions(table.read()).values()) == {1, 2}
    table.replace(1, spark.createDataFrame([], model.STATE))
    assert versions(table.read()) == {f"P{i}": 2 for i in range(20)}


def test_marks_are_pruned_and_forgotten(spark, tmp_path):
    day = 86400
    table = MarkTable(spark, str(tmp_path / "m"), buckets=8)
    base = int(at(0).replace(tzinfo=dt.timezone.utc).timestamp())
    assert table.read(5, base) is None
    for batch in range(4):
        marks = [(f"e{batch}-{i}", "P", "W", at(batch * day * 1000 + i)) for i in range(30)]
        rows = spark.createDataFrame(marks, model.MARKS)
        table.write(batch, rows)
        if batch == 2:
            table.write(batch, rows)  # a batch that runs again
    now = base + 3 * day
    assert {r.event_id[:2] for r in table.read(4, now).collect()} == {"e2", "e3"}
    assert {r.event_id[:2] for r in table.read(3, now).collect()} == {"e2"}
    one = spark.createDataFrame([("e3-7",)], "event_id string").select(table.bucket_of()).first()[0]
    pruned = table.read(4, now, [one])
    assert "e3-7" in {r.event_id for r in pruned.collect()} and pruned.distinct().count() < 30
    scan = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", scan) and re.search(r"PartitionFilters: \[[^\]]*mark_day", scan)
    read = {re.search(r"bucket=(\d+)", r[0]).group(1) for r in pruned.select(F.input_file_name()).distinct().collect()}
    assert read == {str(one)}
    assert table.forget(now) == [base // day, base // day + 1]
    assert sorted(int(d[9:]) for d in os.listdir(tmp_path / "m") if d.startswith("mark_day=")) == [base // day + 2, base // day + 3]
    assert table.forget(now) == []


def test_merge_asks_for_newer_versions_only(spark, monkeypatch):
    """No catalog with MERGE is at hand: what is asked of one."""
    asked = []

    class Writer:
        def __init__(self, table, on):
            asked.append((table, str(on)))

        def whenMatched(self, condition):
            asked.append(("matched", str(condition)))
            return self

        def whenNotMatched(self):
            asked.append(("missing",))
            return self

        def updateAll(self):
            asked.append("update")
            return self

        insertAll = updateAll

        def merge(self):
            asked.append("merge")

    monkeypatch.setattr(type(spark.range(1)), "mergeInto", lambda df, table, on: Writer(table, on), raising=False)
    merge_into_table(resolve.versioned_upsert(None, gated_events(spark, [(0, "a", "P", "W", 5, 0)])), "shop.stock")
    assert asked[0][0] == "shop.stock" and all(f"shop.stock.{k}" in asked[0][1] and f"batch.{k}" in asked[0][1] for k in model.KEY)
    assert asked[1][0] == "matched" and "shop.stock.row_version" in asked[1][1] and "<" in asked[1][1]
    assert asked[2:] == ["update", ("missing",), "update", "merge"]


def test_read_model_queries(spark):
    state = resolve.versioned_upsert(
        None, gated_events(spark, [(0, "a", "P", "W", 1, 0), (1, "b", "P", "V", 1, 5), (2, "c", "Q", "W", 1, 9)])
    ).cache()
    assert readmodel.by_product(state, "P").count() == 2
    assert readmodel.by_product(state, "P", "V").count() == 1
    assert readmodel.by_status(state, "OOS").count() == 0
    assert [r.product_id for r in readmodel.recently_updated(state, 1).collect()] == ["Q"]
    assert [r.warehouse_id for r in readmodel.by_commit_recency(state, 2).collect()] == ["W", "V"]
    plan = readmodel.recently_updated(state, 1)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_reservations(spark):
    rows = [("O1", 1, "P", "W", 2, "OPEN", at(i)) for i in range(5)] + [("O2", 1, "Q", "W", 2, "OPEN", at(0))]
    res = spark.createDataFrame(
        rows, "order_id string, line_number int, product_id string, warehouse_id string, quantity int, "
        "reservation_status string, created_at timestamp",
    )
    assert readmodel.reservations_for_order(res, "O2").count() == 1
    top = readmodel.reservations_for_sku(res, 2)
    assert top.count() == 3
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_read_log_arguments(spark, tmp_path):
    with pytest.raises(ValueError, match="brokers"):
        L.read_log(spark)
    with pytest.raises(ValueError, match="topic and group_id"):
        L.read_log(spark, brokers=["b:1"])
    with pytest.raises(ValueError, match="topic and group_id"):
        L.read_log(spark, brokers=["b:1"], topic="t")
    with pytest.raises(ValueError):
        S.read_source_table(spark)
    log_of(spark, ["{}"]).write.parquet(str(tmp_path / "log"))
    assert L.read_log(spark, str(tmp_path / "log")).schema == model.LOG
    assert L.read_log(spark, str(tmp_path / "log"), streaming=True).isStreaming


def test_stream_admission(spark, monkeypatch):
    """The Kafka source isn't here: the options it would get."""
    from pyspark.sql.streaming import DataStreamReader

    def options(**kw):
        given = {}
        monkeypatch.setattr(DataStreamReader, "option", lambda self, k, v: given.update({k: v}) or self)
        monkeypatch.setattr(DataStreamReader, "load", lambda self: spark.createDataFrame([], model.LOG))
        L.read_log(spark, brokers=["b:1", "c:2"], topic="t", group_id="g", streaming=True, **kw)
        return given

    plain = options()
    assert (plain["minOffsetsPerTrigger"], plain["maxTriggerDelay"]) == (25, "500ms") and "maxOffsetsPerTrigger" not in plain
    bounded = options(max_offsets_per_trigger=9000, min_offsets_per_trigger=400, max_trigger_delay="2s")
    assert (bounded["minOffsetsPerTrigger"], bounded["maxOffsetsPerTrigger"], bounded["maxTriggerDelay"]) == (400, 9000, "2s")
    assert "minOffsetsPerTrigger" not in options(min_offsets_per_trigger=None)
    with pytest.raises(ValueError, match="exceeds"):
        options(max_offsets_per_trigger=10)


def test_route_topic_matches_whole_names(spark):
    log = log_of(spark, ["{}"]).withColumn("topic", F.explode(F.array(*[F.lit(t) for t in ("a.b", "a.b.c", "x.a.b", "aXb")])))
    out = {r.topic for r in L.route_topic(log, r"a\.(b)", "n.$1").collect()}
    assert out == {"n.b", "a.b.c", "x.a.b", "aXb"}


def test_tolerant_parse(spark):
    good, dead = L.tolerant_parse(log_of(spark, ["{}", "{", "", None, '{"op":5}']))
    assert sorted(r.offset for r in good.collect()) == [0, 3, 4]
    rows = {r.offset: r.headers for r in dead.collect()}
    assert set(rows) == {1, 2} and rows[1]["__connect.errors.offset"] == "1"


def test_capture_columns(spark):
    body = {"op": "u", "source": {"schema": "public", "table": "warehouse_inventory"},
            "after": {"product_id": "P", "warehouse_id": "W", "available_qty": 3, "stock_status": "LOW", "row_version": 1}}
    other = json.loads(json.dumps(body))
    other["source"]["table"] = "orders"
    events = L.capture_columns(decode(log_of(spark, [json.dumps(body), json.dumps(other)])), ["public.warehouse_inventory"], ["available_qty"])
    rows = events.collect()
    assert len(rows) == 1 and rows[0].after.asDict() == {"available_qty": 3} and rows[0].before is None


def test_bench_files(spark, tmp_path):
    from changeflow.operators.metrics import bench_summary

    runs = [
        {"scenario": "sustained", "events_sent": 10, "events_failed": 0, "elapsed_seconds": 1.0, "effective_rate": r, "run": i}
        for i, r in enumerate((10.0, 12.0, 14.0))
    ] + [
        {"scenario": "burst", "events_sent": 7, "effective_rate": 5.0},
        {"events_sent": 3, "effective_rate": 2.5},
        {"scenario": "no rate", "events_sent": 3},
    ]
    for i, r in enumerate(runs):
        (tmp_path / f"r{i}.json").write_text(json.dumps(r, indent=2))
    (tmp_path / "bad.json").write_text('{"scenario": ')
    good, bad = S.read_bench_runs(spark, str(tmp_path))
    assert [r.file.rsplit("/", 1)[1] for r in bad.collect()] == ["bad.json"]
    out = {r.scenario: r for r in bench_summary(good).collect()}
    assert set(out) == {"sustained", "burst", "unknown"}
    s = out["sustained"]
    assert (s.runs, s.rate_mean, s.rate_stdev, s.events_sent_total) == (3, 12.0, 1.63, 30)
    assert out["burst"].rate_stdev == 0.0


def test_staged_tables_are_built_of_methods_that_the_jvm_compiles(spark):
    limit, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(limit)

    def build():
        seen.append(spark.conf.get(limit))
        return spark.range(3)

    assert session.stage(spark, "methods", "here", build).count() == 3
    assert (seen, spark.conf.get(limit)) == (["8000"], before)


def test_website_is_no_second_table(spark, small_dir):
    rows = queries.website(spark, small_dir)
    assert rows.count() > 0
    files = rows.inputFiles()
    assert files and all("/warehouse-" in f for f in files)
