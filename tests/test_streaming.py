import random

import pytest
from pyspark.sql import functions as F

from changeflow.functions.decode import decode
from changeflow.operators import gates, resolve
from changeflow.plans import fixtures as fx
from changeflow.session import delete, folders, scratch_path
from changeflow.sources.log import read_log
from changeflow.streaming.pipeline import Pipeline, Settings
from changeflow.streaming.readmodel import ReadModelStream

COLUMNS = ["kafka_offset", "event_id", "result", "dlq_reason", "schema_decision", "latency_ms"]
STATE = ["product_id", "warehouse_id", "available_qty", "stock_status", "row_version", "last_event_id", "updated_at"]


def rows(df, columns):
    return sorted(df.select(*columns).collect(), key=repr)


@pytest.fixture(scope="module")
def truth(spark, small_dir):
    # The first nine days: every micro-batch writes one folder per day.
    log = fx.change_log(spark, small_dir).filter("timestamp < '2024-01-10'").cache()
    gated = gates.gate(decode(log)).cache()
    out = resolve.event_outcomes(gated).cache()
    return log, rows(out, COLUMNS), rows(resolve.versioned_upsert(None, out), STATE)


def write_batches(log, path, cuts):
    bounds = [0, *cuts, 10**9]
    for lo, hi in zip(bounds, bounds[1:]):
        log.filter((F.col("offset") >= lo) & (F.col("offset") < hi)).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("seed, hot_rows", [(1, 10**6), (2, 5)])
def test_stream_equals_batch(spark, truth, tmp_path, seed, hot_rows):
    log, want, want_state = truth
    cuts = sorted(random.Random(seed).sample(range(10, 2_800), 2))
    # Offsets, not file times, decide the order: one file per trigger, written in order.
    for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 10**9])):
        write_batches(log.filter((F.col("offset") >= lo) & (F.col("offset") < hi)), str(tmp_path / "log"), [])
    pipe = Pipeline(spark, Settings(str(tmp_path / "out"), buckets=4, hot_rows=hot_rows))
    stream = read_log(spark, str(tmp_path / "log"), streaming=True, max_files_per_trigger=1)
    query = pipe.start(stream, str(tmp_path / "checkpoint"), available_now=True)
    query.awaitTermination(300)
    assert query.exception() is None
    assert rows(pipe.outcomes(), COLUMNS) == want
    assert rows(pipe.state.read(), STATE) == want_state
    dead = sum(1 for r in want if r.result == "dlq")
    assert spark.read.parquet(pipe.dlq).count() == dead
    assert spark.read.parquet(pipe.audit).count() == len(want)


def test_a_repeated_batch_changes_nothing(spark, truth, tmp_path):
    log, want, want_state = truth
    pipe = Pipeline(spark, Settings(str(tmp_path / "out"), buckets=4))
    first, second = log.filter("offset < 1400"), log.filter("offset >= 1400")
    pipe.process(pipe.events(first), 0)
    pipe.process(pipe.events(second), 1)
    pipe.process(pipe.events(second), 1)
    # A batch that died when the outcomes were written, but not yet the rest.
    delete(spark, f"{tmp_path}/out/state/staged")
    delete(spark, f"{pipe.dlq}/batch_id=1")
    pipe.process(pipe.events(second), 1)
    pipe.process(pipe.events(log.limit(0)), 2)
    assert rows(pipe.outcomes(), COLUMNS) == want
    assert rows(pipe.state.read(), STATE) == want_state


def test_batches_leave_no_scratch_tables(spark, truth, tmp_path):
    log, _, _ = truth
    pipe = Pipeline(spark, Settings(str(tmp_path / "out"), buckets=4))
    before = set(folders(spark, scratch_path(spark, "")))
    pipe.process(pipe.events(log.filter("offset < 900")), 0)
    assert set(folders(spark, scratch_path(spark, ""))) == before


def test_replayed_history_is_a_no_op(spark, truth, tmp_path):
    """Replay: the same messages again within the marks' life leave the state as it is."""
    log, _, want_state = truth
    pipe = Pipeline(spark, Settings(str(tmp_path / "out"), buckets=4, ttl_seconds=10**9))
    pipe.process(pipe.events(log), 0)
    pipe.process(pipe.events(log.withColumn("offset", F.col("offset") + 10**6)), 1)
    again = pipe.outcomes().filter("batch_id = 1")
    assert again.filter("result = 'applied'").count() == 0
    assert rows(pipe.state.read(), STATE) == want_state


def test_dedupe_by_id_through_batches(spark, truth, tmp_path):
    log, _, _ = truth
    gated = gates.gate(decode(log)).cache()
    want = resolve.event_outcomes(gated, dedupe="id").cache()
    pipe = Pipeline(spark, Settings(str(tmp_path / "out"), buckets=4, dedupe="id"))
    for i, part in enumerate((log.filter("offset < 1400"), log.filter("offset >= 1400"))):
        pipe.process(pipe.events(part), i)
    assert rows(pipe.outcomes(), COLUMNS) == rows(want, COLUMNS)
    assert rows(pipe.state.read(), STATE) == rows(resolve.versioned_upsert(None, want), STATE)


@pytest.mark.parametrize("seed", [3, 4])
def test_read_model_from_the_state_store(spark, truth, tmp_path, seed):
    """Any split, with a restart in between: each batch emits the keys it changed, and together they are the read model."""
    log, _, want_state = truth
    gated = gates.gate(decode(log)).cache()
    out = resolve.event_outcomes(gated).cache()
    cuts = sorted(random.Random(seed).sample(range(10, 2_800), 3))
    source, checkpoint = str(tmp_path / "outcomes"), str(tmp_path / "checkpoint")
    model = ReadModelStream(spark, str(tmp_path / "changes"))
    assert model.current().count() == 0
    for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 10**9])):
        part = out.filter((F.col("kafka_offset") >= lo) & (F.col("kafka_offset") < hi))
        part.coalesce(1).write.parquet(f"{source}/batch_id={i}")
        query = ReadModelStream(spark, model.root).start(source, checkpoint, available_now=True, max_files_per_trigger=1)
        query.awaitTermination(300)
        assert query.exception() is None
        changed = spark.read.parquet(f"{model.root}/batch_id={i}")
        applied = part.filter("result = 'applied'").select("product_id", "warehouse_id").distinct()
        assert rows(changed, ["product_id", "warehouse_id"]) == rows(applied, ["product_id", "warehouse_id"])
    assert rows(model.current(), STATE) == want_state
