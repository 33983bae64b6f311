"""The registered queries: one per operator, each over whole tables.

The log, the gated events, the outcomes and the state are staged once per
application (``session.stage``) the way the pipeline writes them, so a metrics
query reads the outcome table instead of decoding the log again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import model
from changeflow.functions.decode import CANONICAL, DEBEZIUM, decode, latest_row, projection_defaults
from changeflow.model import KEY
from changeflow.operators import alerts, conservation, gates, ledger, metrics, readmodel, reconcile, replay, resolve, slo
from changeflow.operators.contract import (
    Contract,
    contract_types,
    field_present,
    load_contract,
    schema_guard,
    unknown_fields,
)
from changeflow.plans import fixtures as fx
from changeflow.session import scratch_path, stage, use_utc
from changeflow.sinks.state import StateTable
from changeflow.sinks.tables import append_audit, dlq_messages, read_audit, seed_missing, write_dlq
from changeflow.sources.log import capture_columns, read_log, route_topic, tolerant_parse
from changeflow.sources.tables import read_bench_runs, snapshot_to_events

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return fn(spark, sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _registry[fn.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_registry)


# --- staged inputs ----------------------------------------------------------------------------


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, "decoded", sf_dir, lambda: decode(fx.change_log(spark, sf_dir)))


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, "gated", sf_dir, lambda: gates.gate(decode(fx.change_log(spark, sf_dir))))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, "outcomes", sf_dir, lambda: resolve.event_outcomes(gated(spark, sf_dir)))


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Clustered by product, so that a lookup reads the row groups that can hold the product.
    rows = lambda: resolve.versioned_upsert(None, outcomes(spark, sf_dir)).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    return stage(spark, "state", sf_dir, rows)


def website(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A projection of the staged source table: readers compute the columns they take, no second table is written.
    return fx.website(spark, sf_dir)


def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Clustered by order, so that a lookup reads the row groups that can hold the order.
    rows = lambda: fx.reservations(spark, sf_dir).repartitionByRange("order_id").sortWithinPartitions("order_id")
    return stage(spark, "reservations", sf_dir, rows)


def mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.mismatch_view(fx.source_table(spark, sf_dir), website(spark, sf_dir))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.dlq_envelope(gated(spark, sf_dir).filter(F.col("dlq_reason").isNotNull()))


def _own_path(spark: SparkSession, name: str, sf_dir: str) -> str:
    return scratch_path(spark, f"{name}-{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}")


def _ms(column: str | Column) -> Column:
    return F.unix_millis(column)


def off() -> Column:
    return F.col("kafka_offset").alias("off")


# Required paths without the after image: deletes then pass the contract.
DELETES_PASS = Contract("v3", ["event_id", "op", "product_id", "warehouse_id", "schema_version", "event_time"])


# --- sources and sinks ------------------------------------------------------------------------


@query
def s1_read_log(spark, sf_dir):
    fx.change_log(spark, sf_dir)
    log = read_log(spark, _own_path(spark, "log", sf_dir))
    return log.select(
        "topic",
        "partition",
        F.col("offset").alias("off"),
        "key",
        _ms("timestamp").alias("log_ms"),
        F.length("value").alias("chars"),
        F.md5("value").alias("digest"),
    )


@query
def s2_source_table(spark, sf_dir):
    return fx.source_table(spark, sf_dir).select(
        *KEY, "available_qty", "reserved_qty", "stock_status", "row_version", _ms("last_updated").alias("updated_ms")
    )


SNAPSHOT_AT = "2024-02-01 00:00:00"


@query
def s3_snapshot_events(spark, sf_dir):
    log = snapshot_to_events(fx.source_table(spark, sf_dir), F.lit(SNAPSHOT_AT).cast("timestamp"), lsn=77, tx_id=5)
    return decode(log).select(
        off(), "op", "event_id", *KEY, "after.available_qty", "after.row_version", _ms("event_time").alias("event_ms")
    )


@query
def s4_capture_columns(spark, sf_dir):
    scoped = capture_columns(decoded(spark, sf_dir), ["public.warehouse_inventory"], ["available_qty", "row_version"])
    return scoped.select(
        off(),
        F.col("before.available_qty").alias("before_qty"),
        F.col("before.row_version").alias("before_version"),
        F.col("after.available_qty").alias("after_qty"),
        F.col("after.row_version").alias("after_version"),
        F.size(F.json_object_keys(F.to_json(F.coalesce("after", "before")))).alias("columns"),
    )


@query
def s5_route_topic(spark, sf_dir):
    raw = fx.change_log(spark, sf_dir).withColumn(
        "topic",
        F.when(F.col("partition") % 3 == 0, F.lit("cdc.inventory.public.warehouse_inventory.old")).otherwise(
            F.lit("cdc.inventory.public.warehouse_inventory")
        ),
    )
    routed = route_topic(raw, r"cdc\.inventory\.public\.warehouse_inventory", "cdc.inventory.warehouse")
    return routed.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("messages"))


S7_BATCHES = 3


@query
def s7_merge_state(spark, sf_dir):
    events = gated(spark, sf_dir)
    # A table of its own for each run: the batches begin with an empty read model.
    table = StateTable(spark, scratch_path(spark, f"s7-{uuid.uuid4().hex}"), buckets=8)
    # Batches are ranges of offsets that cover the log; the table carries the read model between them.
    marks = None
    low, high = events.agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
    for batch_id in range(S7_BATCHES if low is not None else 0):
        part = events.filter(F.floor((F.col("kafka_offset") - low) * S7_BATCHES / (high - low + 1)) == batch_id)
        before = table.read(table.touched(part.filter(F.col("dlq_reason").isNull())))
        result = resolve.event_outcomes(part, before, marks)
        table.replace(batch_id, resolve.versioned_upsert(before, result))
        marks = resolve.mark_applied(result, marks)
    return table.read().select(*KEY, "available_qty", "row_version")


@query
def s8_dlq_sink(spark, sf_dir):
    path = _own_path(spark, "s8", sf_dir)
    write_dlq(dlq_messages(dead_letters(spark, sf_dir)), path)
    envelope = F.from_json(
        "value",
        "original_topic STRING, original_partition INT, original_offset BIGINT, event_id STRING, reason STRING, "
        "reason_detail STRING, first_failed_at TIMESTAMP, raw_payload STRING",
    )
    header = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return spark.read.parquet(path).select("topic", "key", envelope.alias("e"), header.alias("h")).select(
        "topic",
        "key",
        F.col("h")["x-dlq-reason"].alias("reason_header"),
        F.col("h")["x-original-topic"].alias("topic_header"),
        F.col("e.original_partition").alias("partition"),
        F.col("e.original_offset").alias("off"),
        "e.event_id",
        "e.reason",
        _ms("e.first_failed_at").alias("failed_ms"),
        F.md5("e.raw_payload").alias("digest"),
    )


def _audit(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = _own_path(spark, name, sf_dir)
    events = gated(spark, sf_dir)
    for batch_id in (0, 1):
        append_audit(events.filter(F.floor(F.col("kafka_offset") / 5000) % 2 == batch_id), root, batch_id)
    return read_audit(spark, root)


@query
def s9_audit_history(spark, sf_dir):
    return _audit(spark, sf_dir, "s9").groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("batch_id").alias("batches"),
        F.min("kafka_offset").alias("first_off"),
        F.max("kafka_offset").alias("last_off"),
    )


def _bench_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event type and day, in the shape the load scripts write."""
    day = F.to_date("ts")
    span = F.unix_seconds(F.max(F.col("ts").cast("timestamp"))) - F.unix_seconds(F.min(F.col("ts").cast("timestamp")))
    sent = F.col("events_sent")
    return (
        fx.table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("scenario"), F.dayofmonth(day).cast("bigint").alias("run"))
        .agg(F.count(F.lit(1)).alias("events_sent"), span.cast("double").alias("elapsed_seconds"))
        .select(
            F.when(F.col("scenario") != "click", F.col("scenario")).alias("scenario"),
            "events_sent",
            F.lit(0).cast("bigint").alias("events_failed"),
            "elapsed_seconds",
            F.when(
                F.col("elapsed_seconds") > 0, F.floor(F.lit(100.0) * sent / F.col("elapsed_seconds")) / F.lit(100.0)
            ).alias("effective_rate"),
            "run",
        )
    )


@query
def s10_read_bench_runs(spark, sf_dir):
    """One JSON document per file: the day's records land in one file per scenario and run."""
    path = _own_path(spark, "s10", sf_dir)
    runs = _bench_runs(spark, sf_dir)
    (
        runs.select(
            F.to_json(F.struct(*runs.columns)).alias("value"),
            F.coalesce("scenario", F.lit("none")).alias("s"),
            F.col("run").alias("r"),
        )
        .write.mode("overwrite")
        .partitionBy("s", "r")
        .text(path)
    )
    good, _ = read_bench_runs(spark, path, "*.txt")
    return good


@query
def s11_tolerant_parse(spark, sf_dir):
    _, dead = tolerant_parse(fx.change_log(spark, sf_dir))
    return dead.select(
        "partition",
        F.col("offset").alias("off"),
        F.col("headers")["__connect.errors.offset"].alias("offset_header"),
        F.col("headers")["__connect.errors.stage"].alias("stage"),
    )


@query
def s12_seed_missing(spark, sf_dir):
    now = F.lit(SNAPSHOT_AT).cast("timestamp")
    return seed_missing(website(spark, sf_dir), fx.source_table(spark, sf_dir), now).select(
        *KEY, "available_qty", "row_version", "last_event_id", _ms("last_db_commit_ts").alias("commit_ms")
    )


# --- decode -----------------------------------------------------------------------------------


def _of_shape(spark, sf_dir, shape: str) -> DataFrame:
    return decoded(spark, sf_dir).filter(F.col("envelope") == shape)


@query
def p1_probe_envelope(spark, sf_dir):
    return decoded(spark, sf_dir).select(off(), "envelope", "decode_error")


@query
def p2_decode_canonical(spark, sf_dir):
    return _of_shape(spark, sf_dir, CANONICAL).select(
        off(), "event_id", _ms("event_time").alias("event_ms"), "op", *KEY, "schema_version",
        F.col("before.available_qty").alias("before_qty"), F.col("before.row_version").alias("before_version"),
        F.col("after.available_qty").alias("after_qty"), F.col("after.row_version").alias("after_version"),
    )


@query
def p3_decode_debezium(spark, sf_dir):
    return _of_shape(spark, sf_dir, DEBEZIUM).select(
        off(), "op", "source.db", "source.schema", F.col("source.table").alias("table_name"), "source.tx_id",
        F.col("before.available_qty").alias("before_qty"), F.col("before.reserved_qty").alias("before_reserved"),
        F.col("before.stock_status").alias("before_status"), F.col("before.row_version").alias("before_version"),
        F.col("after.available_qty").alias("after_qty"), F.col("after.reserved_qty").alias("after_reserved"),
        F.col("after.stock_status").alias("after_status"), F.col("after.row_version").alias("after_version"),
    )


@query
def p4_derive_event_id(spark, sf_dir):
    return _of_shape(spark, sf_dir, DEBEZIUM).select(off(), "event_id")


@query
def p5_derive_event_time(spark, sf_dir):
    return _of_shape(spark, sf_dir, DEBEZIUM).select(
        off(), _ms("event_time").alias("event_ms"), F.col("source.ts_ms").alias("source_ms")
    )


@query
def p6_normalize_lsn(spark, sf_dir):
    return _of_shape(spark, sf_dir, DEBEZIUM).select(off(), "source.lsn")


@query
def p7_promote_keys(spark, sf_dir):
    return _of_shape(spark, sf_dir, DEBEZIUM).select(off(), "op", *KEY)


@query
def p8_default_schema_version(spark, sf_dir):
    return decoded(spark, sf_dir).filter("decode_error IS NULL").groupBy("envelope", "schema_version").agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def p9_latest_row(spark, sf_dir):
    row = latest_row(F.col("op"), F.col("before"), F.col("after"))
    return decoded(spark, sf_dir).filter("decode_error IS NULL").select(
        off(), row["available_qty"].alias("available_qty"), row["row_version"].alias("row_version")
    )


@query
def p10_projection_defaults(spark, sf_dir):
    return projection_defaults(decoded(spark, sf_dir)).select(
        off(), "has_image", "stock_status", _ms("commit_ts").alias("commit_ms")
    )


@query
def p11_attach_position(spark, sf_dir):
    return decoded(spark, sf_dir).select("topic", F.col("kafka_partition").alias("part"), off(), "event_id")


# --- gates ------------------------------------------------------------------------------------


@query
def v1_required_fields(spark, sf_dir):
    return decoded(spark, sf_dir).filter("decode_error IS NULL").select(off(), gates.required_fields().alias("missing"))


@query
def v2_schema_guard(spark, sf_dir):
    checked = decoded(spark, sf_dir).filter("decode_error IS NULL").filter(gates.required_fields().isNull())
    return checked.select(off(), schema_guard(load_contract()).alias("v")).select("off", "v.*")


PATHS = [*load_contract().required_fields, "after.colour"]


@query
def v3_field_present(spark, sf_dir):
    events = decoded(spark, sf_dir).filter("decode_error IS NULL")
    return events.agg(*[F.count_if(field_present(p)).alias(f"p{i}") for i, p in enumerate(PATHS)]).select(
        F.inline(F.array(*[F.struct(F.lit(p).alias("path"), F.col(f"p{i}").alias("present")) for i, p in enumerate(PATHS)]))
    )


@query
def v4_constraint_violations(spark, sf_dir):
    rows = projection_defaults(decoded(spark, sf_dir).filter("decode_error IS NULL"))
    return gates.constraint_violations(rows, gates.website_checks("event_id")).select(
        off(), F.concat_ws(",", "violations").alias("violations")
    )


@query
def v5_validate_constraints(spark, sf_dir):
    web = gates.validate_constraints(website(spark, sf_dir), gates.website_checks())
    source = gates.validate_constraints(fx.source_table(spark, sf_dir), gates.warehouse_checks())
    return web.unionByName(source)


@query
def v6_route_dlq(spark, sf_dir):
    good, dead = gates.route_dlq(gated(spark, sf_dir))
    return good.unionByName(dead).groupBy("dlq_reason", "dlq_detail").agg(F.count(F.lit(1)).alias("events"))


@query
def v7_dlq_envelope(spark, sf_dir):
    return dead_letters(spark, sf_dir).select(
        "original_topic", "original_partition", F.col("original_offset").alias("off"), "event_id", "reason",
        "reason_detail", _ms("first_failed_at").alias("failed_ms"), F.length("raw_payload").alias("chars"),
    )


@query
def v8_contract_types(spark, sf_dir):
    strict = Contract("v3", ["event_id"], {"event_id": "string", "after.available_qty": "string", "after.row_version": "long"})
    return contract_types(fx.change_log(spark, sf_dir), strict).select(
        F.col("offset").alias("off"), F.concat_ws(",", "type_errors").alias("type_errors")
    )


def _every_seventh(log: DataFrame, changed: Column) -> DataFrame:
    return log.withColumn("value", F.when(F.floor(F.col("offset") / 10) % 7 == 0, changed).otherwise(F.col("value")))


@query
def v9_unknown_fields(spark, sf_dir):
    log = _every_seventh(
        fx.change_log(spark, sf_dir), F.regexp_replace("value", r"^\{", '{"colour":"red","batch":1,')
    )
    return unknown_fields(log).select(F.col("offset").alias("off"), F.concat_ws(",", "unknown_fields").alias("unknown"))


@query
def v10_apply_mapping(spark, sf_dir):
    log = _every_seventh(fx.change_log(spark, sf_dir), F.regexp_replace("value", '"available_qty"', '"qty_on_hand"'))
    renames = {f"{side}.available_qty": f"{side}.qty_on_hand" for side in ("before", "after")}
    events = decode(log, renames).filter("decode_error IS NULL")
    row = latest_row(F.col("op"), F.col("before"), F.col("after"))
    return events.select(off(), row["available_qty"].alias("available_qty"))


# --- dedupe, order, upsert --------------------------------------------------------------------


def _seen_before(spark, sf_dir, dedupe: str) -> DataFrame:
    events = gated(spark, sf_dir)
    first = events.filter(F.col("kafka_offset") % 10 == 0)
    repeats = events.filter((F.col("kafka_offset") % 10 != 0) & F.col("dlq_reason").isNull())
    marks = resolve.mark_applied(resolve.event_outcomes(first, dedupe=dedupe))
    return resolve.was_applied(repeats, marks, dedupe=dedupe).select(off(), "event_id", "seen")


@query
def d1_was_applied(spark, sf_dir):
    """First deliveries are resolved and marked; the repeats then ask the marks."""
    return _seen_before(spark, sf_dir, resolve.ID_AND_KEY)


@query
def d1_was_applied_by_id(spark, sf_dir):
    return _seen_before(spark, sf_dir, resolve.ID)


@query
def d2_mark_applied(spark, sf_dir):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return resolve.mark_applied(outcomes(spark, sf_dir), now=now).select(
        resolve.mark_key(F.col("event_id")).alias("mark"), *KEY, _ms("marked_at").alias("marked_ms")
    )


@query
def d3_versioned_upsert(spark, sf_dir):
    final = resolve.versioned_upsert(None, outcomes(spark, sf_dir))
    return final.select(
        *KEY, "available_qty", "reserved_qty", "stock_status", "row_version", "last_event_id",
        _ms("last_db_commit_ts").alias("commit_ms"), _ms("updated_at").alias("updated_ms"),
    )


def _outcome_rows(df: DataFrame) -> DataFrame:
    return df.select(
        off(), "event_id", "result", F.col("dlq_reason").alias("reason"), F.col("dlq_detail").alias("detail"),
        "schema_decision", "latency_ms",
    )


@query
def d4_event_outcomes(spark, sf_dir):
    return _outcome_rows(resolve.event_outcomes(gated(spark, sf_dir)))


@query
def d4_event_outcomes_in_blocks(spark, sf_dir):
    """The same answer by the path for keys too large for one task (limit lowered to reach it)."""
    return _outcome_rows(resolve.event_outcomes(gated(spark, sf_dir), hot_rows=12))


@query
def d4_event_outcomes_by_id(spark, sf_dir):
    """An id is remembered for all keys, as where the id alone is the mark."""
    return _outcome_rows(resolve.event_outcomes(gated(spark, sf_dir), dedupe=resolve.ID))


@query
def d4_id_conflicts(spark, sf_dir):
    return resolve.id_conflicts(gated(spark, sf_dir))


@query
def d4_result_counts(spark, sf_dir):
    """The whole way from log text to outcome counts."""
    events = stage(spark, "gated", sf_dir, lambda: gates.gate(decode(fx.change_log(spark, sf_dir))))
    return resolve.event_outcomes(events).groupBy("result", F.col("dlq_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def d5_apply_delete(spark, sf_dir):
    """Deletes as events: a contract that lets them pass, and a tombstone as their effect."""
    events = gates.gate(decoded(spark, sf_dir), DELETES_PASS)
    return resolve.versioned_upsert(None, events, "tombstone").select(
        *KEY, "available_qty", "stock_status", "row_version", "last_event_id"
    )


@query
def d6_ordering_check(spark, sf_dir):
    return resolve.ordering_check(gated(spark, sf_dir)).select(
        off(), *KEY, "row_version", "previous_version", "version_not_newer", "partition_changed"
    )


@query
def d7_sync_latency(spark, sf_dir):
    return resolve.sync_latency(outcomes(spark, sf_dir)).select(off(), "event_id", "latency_seconds")


# --- reconcile and replay ---------------------------------------------------------------------


@query
def r1_reconcile(spark, sf_dir):
    return reconcile.reconcile(fx.source_table(spark, sf_dir), website(spark, sf_dir))


@query
def r2_mismatch_view(spark, sf_dir):
    return mismatches(spark, sf_dir).select(
        *KEY, "warehouse_qty", "website_qty", "warehouse_version", "website_version",
        _ms("warehouse_updated_at").alias("warehouse_updated_ms"),
        _ms("website_updated_at").alias("website_updated_ms"), "reason",
    )


@query
def r3_mismatch_by_reason(spark, sf_dir):
    return reconcile.mismatch_by_reason(mismatches(spark, sf_dir))


@query
def r4_replay_window(spark, sf_dir):
    return reconcile.replay_window(mismatches(spark, sf_dir), website(spark, sf_dir)).select(
        _ms("since").alias("since_ms"), _ms("until").alias("until_ms")
    )


@query
def r5_replay_from_audit(spark, sf_dir):
    bounds = [F.lit(f"2024-01-{d} 06:30:00").cast("timestamp") for d in ("10", "14")]
    replayed = replay.replay_from_audit(_audit(spark, sf_dir, "r5"), *bounds)
    return replayed.select("topic", "partition", F.col("offset").alias("off"), "key", F.md5("value").alias("digest"))


@query
def r5_replay_dry_run(spark, sf_dir):
    bounds = [F.lit(f"2024-01-{d} 06:30:00").cast("timestamp") for d in ("10", "14")]
    return replay.replay_count(replay.replay_from_audit(_audit(spark, sf_dir, "r5d"), *bounds))


@query
def r6_replay_dlq(spark, sf_dir):
    """Dead letters of the second half of the month again, under a contract that lets deletes pass."""
    since = F.lit("2024-01-15 00:00:00").cast("timestamp")
    again = gates.gate(decode(replay.replay_dlq(dead_letters(spark, sf_dir), since)), DELETES_PASS)
    return again.select(off(), "dlq_reason", "op", "available_qty")


@query
def r6_first_failures(spark, sf_dir):
    return replay.first_failures(dead_letters(spark, sf_dir)).select(
        F.col("original_offset").alias("off"), _ms("first_failed_at").alias("failed_ms"), "deliveries"
    )


@query
def r7_mismatch_gauge(spark, sf_dir):
    return reconcile.mismatch_gauge(mismatches(spark, sf_dir))


@query
def r8_scheduled_reconcile(spark, sf_dir):
    return reconcile.reconcile_run(
        fx.source_table(spark, sf_dir), website(spark, sf_dir), F.lit(SNAPSHOT_AT).cast("timestamp")
    ).select(_ms("run_at").alias("run_ms"), "reason", "mismatches")


@query
def r9_dlq_investigate(spark, sf_dir):
    return reconcile.dlq_investigate(dead_letters(spark, sf_dir), 5).select(
        F.col("original_offset").alias("off"), "reason", "reason_detail"
    )


# --- read model -------------------------------------------------------------------------------


def _state_rows(df: DataFrame) -> DataFrame:
    return df.select(
        *KEY, "available_qty", "stock_status", "row_version", "last_event_id",
        _ms("last_db_commit_ts").alias("commit_ms"), _ms("updated_at").alias("updated_ms"),
    )


@query
def q1_by_product(spark, sf_dir):
    return _state_rows(readmodel.by_product(state(spark, sf_dir), "SKU-7"))


@query
def q1_by_product_and_warehouse(spark, sf_dir):
    return _state_rows(readmodel.by_product(state(spark, sf_dir), "SKU-7", "WH-1"))


@query
def q2_by_status(spark, sf_dir):
    return _state_rows(readmodel.by_status(state(spark, sf_dir), "OOS"))


@query
def q2_status_counts(spark, sf_dir):
    return readmodel.status_counts(state(spark, sf_dir))


@query
def q3_recently_updated(spark, sf_dir):
    return _state_rows(readmodel.recently_updated(state(spark, sf_dir), 20))


@query
def q4_by_commit_recency(spark, sf_dir):
    return _state_rows(readmodel.by_commit_recency(state(spark, sf_dir), 20))


@query
def q5_reservations_for_order(spark, sf_dir):
    return readmodel.reservations_for_order(reservations(spark, sf_dir), "ORD-7").select(
        "order_id", "line_number", *KEY, "quantity", "reservation_status", _ms("created_at").alias("created_ms")
    )


@query
def q6_reservations_for_sku(spark, sf_dir):
    return readmodel.reservations_for_sku(reservations(spark, sf_dir), 2).select(
        *KEY, "rank", "order_id", "line_number", "quantity", "reservation_status", _ms("created_at").alias("created_ms")
    )


@query
def q7_source_recency(spark, sf_dir):
    return readmodel.source_recency(fx.source_table(spark, sf_dir), 20).select(
        *KEY, "available_qty", "row_version", _ms("last_updated").alias("updated_ms")
    )


# --- metrics ----------------------------------------------------------------------------------



def series_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, "grid", sf_dir, lambda: metrics.fill_grid(metrics.bucketize(outcomes(spark, sf_dir))))


@query
def m1_outcome_counts(spark, sf_dir):
    return metrics.outcome_counts(outcomes(spark, sf_dir))


@query
def m1_outcome_counts_by_partition(spark, sf_dir):
    return metrics.outcome_counts(
        outcomes(spark, sf_dir).withColumnRenamed("kafka_partition", "part"), ["part"]
    )


@query
def m2_latency_histogram(spark, sf_dir):
    return metrics.latency_histogram(outcomes(spark, sf_dir))


@query
def m3_histogram_quantile(spark, sf_dir):
    return metrics.latency_quantiles(outcomes(spark, sf_dir))


@query
def m4_event_rate(spark, sf_dir):
    return metrics.event_rate(series_grid(spark, sf_dir))


@query
def m5_dlq_by_reason(spark, sf_dir):
    return metrics.dlq_by_reason(series_grid(spark, sf_dir))


@query
def m6_schema_warning_count(spark, sf_dir):
    return metrics.schema_warning_count(series_grid(spark, sf_dir))


@query
def m7_consumer_lag(spark, sf_dir):
    log = fx.change_log(spark, sf_dir)
    done = log.filter(F.col("timestamp") < F.lit("2024-01-28 00:00:00").cast("timestamp"))
    return metrics.consumer_lag(log, done)


@query
def m7_topic_lag(spark, sf_dir):
    log = fx.change_log(spark, sf_dir)
    done = log.filter(F.col("timestamp") < F.lit("2024-01-28 00:00:00").cast("timestamp"))
    return metrics.topic_lag(metrics.consumer_lag(log, done))


def lag_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = fx.consumer_commits(spark, sf_dir)
    return metrics.lag_series(fx.change_log(spark, sf_dir), commits, series_grid(spark, sf_dir))


@query
def m7_lag_series(spark, sf_dir):
    """The lag by topic at every step, each partition's offsets carried forward."""
    return lag_series(spark, sf_dir).select("topic", (F.col("bucket") + metrics.STEP).alias("eval_ts"), "lag")


@query
def m7_capture_backlog(spark, sf_dir):
    """Events committed at the source and not yet logged, at every step."""
    commit = F.floor(F.unix_millis("commit_ts") / F.lit(1000)).cast("bigint")
    late = alerts.backlog(outcomes(spark, sf_dir), commit, metrics.log_seconds())
    return late.select((F.col("bucket") + metrics.STEP).alias("eval_ts"), F.col("consumer_lag").alias("events"))


@query
def m8_success_rate(spark, sf_dir):
    return metrics.success_rate(series_grid(spark, sf_dir))


def last_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gauge as the last reconciliation run left it, one row."""
    return stage(spark, "gauge", sf_dir, lambda: reconcile.mismatch_gauge(mismatches(spark, sf_dir)))


def day_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15-second rows as hours, and those as days."""
    hours = stage(spark, "hours", sf_dir, lambda: metrics.rollup(series_grid(spark, sf_dir), 3600))
    return stage(spark, "days", sf_dir, lambda: metrics.fill_grid(metrics.rollup(hours, slo.DAY), slo.DAY))


@query
def m9_slo_report(spark, sf_dir):
    return slo.slo_report(outcomes(spark, sf_dir), last_gauge(spark, sf_dir))


@query
def m9_daily_objectives(spark, sf_dir):
    """The objectives at the end of every day, over the trailing 28 days."""
    return slo.daily_objectives(day_rows(spark, sf_dir), run_history(spark, sf_dir))


@query
def m9_conservation(spark, sf_dir):
    """What the log holds by partition, and what became of it."""
    rows = fx.counted_offsets(outcomes(spark, sf_dir))
    found = conservation.conservation(rows, fx.log_ends(spark, sf_dir), metrics.RESULTS, block_offsets=50)
    return found.withColumnRenamed("partition", "part").drop("topic")


@query
def m9_offset_gaps(spark, sf_dir):
    rows = fx.counted_offsets(outcomes(spark, sf_dir))
    found = conservation.offset_gaps(rows, fx.log_ends(spark, sf_dir), block_offsets=50)
    return found.withColumnRenamed("partition", "part").drop("topic")


@query
def m9_repeated_offsets(spark, sf_dir):
    found = conservation.repeated_offsets(fx.counted_offsets(outcomes(spark, sf_dir)))
    return found.withColumnsRenamed({"partition": "part", "offset": "off"}).drop("topic")


@query
def m9_no_silent_loss(spark, sf_dir):
    rows = fx.counted_offsets(outcomes(spark, sf_dir))
    return conservation.no_silent_loss(conservation.conservation(rows, fx.log_ends(spark, sf_dir), metrics.RESULTS))


@query
def m10_error_budget(spark, sf_dir):
    return slo.error_budget(outcomes(spark, sf_dir))


@query
def m10_daily_budget(spark, sf_dir):
    return slo.daily_budget(day_rows(spark, sf_dir))


@query
def m11_burn_rate(spark, sf_dir):
    return slo.burn_rate(series_grid(spark, sf_dir))


# The test log has few events a minute, and its offsets go up in tens: limits at which every rule has steps on both sides.
LIMITS = alerts.Thresholds(p95_seconds=3.0, lag=20_000, dlq_per_second=0.003, warnings_per_second=0.001, mismatches=5)
CRITICAL_SKUS = ["SKU-1", "SKU-3"]


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """three runs, at each quarter of the log's time: at first all mismatches, then without the missing rows,
    seeded meanwhile, then those of values only."""
    wrong = stage(spark, "wrong", sf_dir, lambda: mismatches(spark, sf_dir).select("product_id", "reason"))
    reason = F.col("reason")
    left = [wrong, wrong.filter(reason != reconcile.MISSING_IN_WEBSITE), wrong.filter(reason == reconcile.VALUE_MISMATCH)]
    rows = [reconcile.run_summary(df, F.lit(k), CRITICAL_SKUS) for k, df in enumerate(left, 1)]
    at = F.unix_millis("log_ts")
    span = outcomes(spark, sf_dir).agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    runs = rows[0].unionByName(rows[1]).unionByName(rows[2]).join(F.broadcast(span), F.lit(True))  # one row
    at = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) * F.col("run_at") / 4).cast("bigint")
    return runs.select(F.timestamp_millis(at).alias("run_at"), "mismatches", "critical_mismatches")


@query
def m12_alert_rules(spark, sf_dir):
    grid = series_grid(spark, sf_dir)
    lag = alerts.worst_lag(lag_series(spark, sf_dir))
    gauges = lag.join(alerts.latest_run(grid, run_history(spark, sf_dir)), "bucket", "left")
    rows = alerts.signals(grid, gauges, F.col("mismatches"))
    return alerts.alert_rules(rows, alerts.shipped_rules(LIMITS))


@query
def m13_threshold_band(spark, sf_dir):
    grid = metrics.rolling(
        series_grid(spark, sf_dir), metrics.per_window([*metrics.LE, "latency_count"], {"5m": 300})
    )
    p95 = alerts.p95("5m")
    return grid.select(
        (F.col("bucket") + metrics.STEP).alias("eval_ts"),
        metrics.threshold_band(p95, 2, 3).alias("latency_band"),
        metrics.threshold_band(p95, 7.0, 7.8).alias("tight_band"),
    )


def oversold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.oversold(ledger.floor_ledger(fx.movements(spark, sf_dir)), F.col("moved_at"))


@query
def m14_severity_triage(spark, sf_dir):
    return severity(spark, sf_dir)


def severity(
    spark: SparkSession, sf_dir: str, limits: alerts.Thresholds = LIMITS, dlq_limit: int = 1, clamp_limit: int = 1, hold: int = 600
) -> DataFrame:
    grid = series_grid(spark, sf_dir)
    sums = metrics.rolling(
        grid.join(oversold(spark, sf_dir).select("bucket", "clamps"), "bucket", "left").fillna(0, ["clamps"]),
        {
            "applied_10m": (model.APPLIED, 600),
            "dlq_5m": (model.DLQ, 300),
            "warnings_15m": ("warnings", 900),
            "received_2h": (model.RECEIVED, 7200),
            "applied_2h": (model.APPLIED, 7200),
            "clamps_10m": ("clamps", 600),
            **metrics.per_window([*metrics.LE, "latency_count"], {"5m": 300}),
        },
    )
    sums = sums.join(alerts.worst_lag(lag_series(spark, sf_dir)), "bucket", "left")
    sums = sums.join(alerts.latest_run(grid, run_history(spark, sf_dir)), "bucket", "left")
    rows = alerts.held(
        sums,
        {
            "latency_high": (alerts.p95("5m") > limits.p95_seconds, hold),
            "lag_high": (F.col("consumer_lag") > limits.lag, hold),
        },
    )
    burn = F.try_divide(F.col("received_2h") - F.col("applied_2h"), F.col("received_2h")) / F.lit(1.0 - slo.SUCCESS_TARGET)
    level = slo.severity_triage(
        halted=F.col("applied_10m") == 0,
        critical_mismatch=F.col("critical_mismatches") > 0,
        latency_high=F.col("latency_high"),
        dlq_last_5m=F.col("dlq_5m"),
        lag_high=F.col("lag_high"),
        schema_warnings=F.col("warnings_15m"),
        burn=burn,
        overselling=F.col("clamps_10m") > clamp_limit,
        dlq_limit=dlq_limit,
    )
    return rows.select((F.col("bucket") + metrics.STEP).alias("eval_ts"), level.alias("severity"))


@query
def m15_bench_summary(spark, sf_dir):
    return metrics.bench_summary(_bench_runs(spark, sf_dir))


# --- ledger -----------------------------------------------------------------------------------


@query
def l1_floor_ledger(spark, sf_dir):
    return ledger.floor_ledger(fx.movements(spark, sf_dir)).select(
        "product_id", F.col("seq").alias("n"), "delta", "on_hand", "row_version"
    )


@query
def l1_floor_ledger_in_blocks(spark, sf_dir):
    return ledger.floor_ledger(fx.movements(spark, sf_dir), hot_rows=50).select(
        "product_id", F.col("seq").alias("n"), "delta", "on_hand", "row_version"
    )


@query
def l2_negative_delta_clamps(spark, sf_dir):
    return ledger.negative_delta_clamps(ledger.floor_ledger(fx.movements(spark, sf_dir))).select(
        "product_id", F.col("seq").alias("n"), "delta", "absorbed"
    )


@query
def l2_oversold_series(spark, sf_dir):
    """The clamps as a series on the evaluation grid's steps."""
    return oversold(spark, sf_dir).select((F.col("bucket") + metrics.STEP).alias("eval_ts"), "clamps", "absorbed")
