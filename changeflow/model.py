"""Schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Row key of every stock table.
KEY = ["product_id", "warehouse_id"]

# --- fixed values: operation codes -------------------------------------------------
OP_INSERT = "c"
OP_UPDATE = "u"
OP_DELETE = "d"
OP_SNAPSHOT = "r"

# --- fixed values: outcome labels ---------------------------------------------------
RECEIVED = "received"
APPLIED = "applied"
SKIPPED = "skipped"
REJECTED = "rejected"
DLQ = "dlq"

# --- fixed values: dead-letter reasons ----------------------------------------------
DECODE_ERROR = "decode_error"
MISSING_REQUIRED = "missing_required"
SCHEMA_BREAKING = "schema_breaking"
PROJECTION_ERROR = "projection_error"
NO_MAPPING = "no_mapping"

# --- fixed values: contract decisions -------------------------------------------------
COMPATIBLE = "compatible"
CONDITIONAL = "conditional"
BREAKING = "breaking"

# --- fixed values: schema version stamped on Debezium-shaped events -------------------
DEBEZIUM_SCHEMA_VERSION = "v3"

# --- fixed values: stock status domain, column widths, defaults ------------------------
STOCK_STATUSES = ["ACTIVE", "LOW", "OOS", "HIDDEN", "DELETED"]
DEFAULT_STOCK_STATUS = "ACTIVE"
MAX_LENGTH = {"product_id": 100, "warehouse_id": 50, "stock_status": 30, "last_event_id": 150}
INT32_MAX = 2147483647

# --- fixed values: dedupe memory -------------------------------------------------------
MARK_TTL_SECONDS = 24 * 60 * 60
MARK_PREFIX = "cdc:applied:"

# --- fixed values: topics ----------------------------------------------------------------
MAIN_TOPIC = "cdc.inventory.warehouse"
DLQ_TOPIC = "cdc.inventory.dlq"

LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("warehouse_id", T.StringType()),
        T.StructField("available_qty", T.IntegerType()),
        T.StructField("reserved_qty", T.IntegerType()),
        T.StructField("stock_status", T.StringType()),
        T.StructField("row_version", T.LongType()),
        T.StructField("last_event_id", T.StringType()),
        T.StructField("last_db_commit_ts", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

MARKS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("warehouse_id", T.StringType()),
        T.StructField("marked_at", T.TimestampType()),
    ]
)

BENCH_RUN = T.StructType(
    [
        T.StructField("scenario", T.StringType()),
        T.StructField("events_sent", T.LongType()),
        T.StructField("events_failed", T.LongType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("effective_rate", T.DoubleType()),
        T.StructField("run", T.LongType()),
    ]
)
