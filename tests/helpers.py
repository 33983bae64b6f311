"""Small builders and the one-at-a-time model the set-based kernel must agree with."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from changeflow import model

EPOCH = dt.datetime(2024, 1, 1)


def at(ms: int) -> dt.datetime:
    return EPOCH + dt.timedelta(milliseconds=ms)


def log_of(spark, values, start_ms=0):
    """Log rows with the given message texts, offsets 0, 1, 2, ..."""
    rows = [("t", 0, i, "k", v, at(start_ms + i)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, model.LOG)


def message(event_id, product, warehouse, version, qty=1, op="u", when="2024-01-01T00:00:00Z", **more):
    body = {
        "event_id": event_id, "event_time": when, "op": op, "product_id": product, "warehouse_id": warehouse,
        "schema_version": "v3", "after": {"available_qty": qty, "row_version": version},
    }
    body.update(more)
    return json.dumps(body)


def gated_events(spark, events):
    """Passing events straight in gated shape. Each: (offset, id, product, warehouse, version, log ms)."""
    rows = [(o, e, p, w, v, at(ms)) for o, e, p, w, v, ms in events]
    df = spark.createDataFrame(
        rows, "kafka_offset bigint, event_id string, product_id string, warehouse_id string, row_version bigint, log_ts timestamp"
    )
    return df.select(
        "*",
        F.lit(0).alias("kafka_partition"),
        F.col("log_ts").alias("event_time"),
        F.col("log_ts").alias("commit_ts"),
        F.lit("u").alias("op"),
        F.col("row_version").alias("available_qty"),
        F.lit(0).cast("bigint").alias("reserved_qty"),
        F.lit("ACTIVE").alias("stock_status"),
        F.lit(None).cast("string").alias("dlq_reason"),
    )


def one_at_a_time(events, ttl_ms, state=None, marks=None, dedupe="id_and_key"):
    """The rules applied to one event after the other, in offset order."""
    state, marks, labels = dict(state or {}), dict(marks or {}), {}
    for offset, event_id, product, warehouse, version, ms in sorted(events):
        key = (product, warehouse)
        mark = event_id if dedupe == "id" else (event_id, key)
        if mark in marks and ms - marks[mark] < ttl_ms:
            labels[offset] = "skipped"
        elif key in state and state[key][0] >= version:
            labels[offset] = "rejected"
        else:
            labels[offset] = "applied"
            state[key] = (version, event_id)
            marks[mark] = max(ms, marks.get(mark, ms))
    return labels, state, marks
