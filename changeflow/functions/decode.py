"""Decode the change log: two JSON envelope shapes into one event row per message.

The text is parsed once, by one ``from_json`` whose schema covers both shapes;
everything after it is typed column work, so the whole decode is one JVM-side
projection without a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model
from changeflow.functions import variant as V

CANONICAL = "canonical"
DEBEZIUM = "debezium"

# --- fixed values: error texts -----------------------------------------------------------
EMPTY_PAYLOAD = "empty payload"
MALFORMED = "json unmarshal: malformed JSON"
WRONG_TYPE = "json unmarshal: wrong type"
NO_ROW = "debezium envelope has no before or after row"

# RFC 3339 with a zone, as the canonical envelope writes event_time.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
ZERO_TIME = "0001-01-01T00:00:00Z"

# Text that a non-string JSON token leaves in a STRING field: a number, a boolean, an object or a list.
_TOKEN_LINE = r"(?m)^(-?[0-9][0-9.eE+-]*$|true$|false$|[\[{])"

# Fields of both shapes. The parser itself refuses a quoted or fractional number
# for a BIGINT field and a scalar for a STRUCT field, but takes any token as text
# for a STRING field; ``_suspect`` finds the messages where that may have happened.
_ROW_FIELDS = {
    "product_id": "STRING",
    "warehouse_id": "STRING",
    "available_qty": "BIGINT",
    "reserved_qty": "BIGINT",
    "stock_status": "STRING",
    "row_version": "BIGINT",
}
_FIELDS = {
    "event_id": "STRING",
    "event_time": "STRING",
    "op": "STRING",
    "product_id": "STRING",
    "warehouse_id": "STRING",
    "schema_version": "STRING",
    "ts_ms": "BIGINT",
    "source": {
        "db": "STRING",
        "schema": "STRING",
        "table": "STRING",
        "lsn": "STRING",
        "txId": "BIGINT",
        "ts_ms": "BIGINT",
    },
    "before": _ROW_FIELDS,
    "after": _ROW_FIELDS,
}
# Text fields that must be JSON strings, by shape (a Debezium lsn may be a number).
_TEXT_IN_BOTH = [
    "event_id", "op", "source.db", "source.table", "source.schema", "before.stock_status", "after.stock_status",
]
_TEXT_IN_CANONICAL = ["product_id", "warehouse_id", "schema_version", "source.lsn"]
_TEXT_IN_DEBEZIUM = ["before.product_id", "before.warehouse_id", "after.product_id", "after.warehouse_id"]


def _field_type(path: str) -> str:
    node = _FIELDS
    for part in path.split("."):
        node = node[part]
    if not isinstance(node, str):
        raise ValueError(f"only leaf fields can be renamed, not {path!r}")
    return node


def _ddl(fields: Mapping) -> str:
    return ", ".join(
        f"`{name}` {kind if isinstance(kind, str) else f'STRUCT<{_ddl(kind)}>'}" for name, kind in fields.items()
    )


def _fields(renames: Mapping[str, str]) -> dict:
    """Message fields, with the old paths of renamed fields added."""
    fields = {k: dict(v) if isinstance(v, dict) else v for k, v in _FIELDS.items()}
    for new, old in renames.items():
        kind = _field_type(new)
        *parents, leaf = old.split(".")
        if len(parents) > 1:
            raise ValueError(f"a renamed field sits at most one level deep: {old!r}")
        (fields.setdefault(parents[0], {}) if parents else fields).setdefault(leaf, kind)
    return fields


def parse(value: Column, fields: Mapping) -> Column:
    """``v`` = list of the JSON values in the text, ``_corrupt`` = text if anything did not fit.

    The list around the message turns text after the first JSON value into a
    syntax error or a second element; both are then seen as malformed.
    """
    return F.from_json(
        F.concat(F.lit('{"v":['), value, F.lit("]}")),
        f"v ARRAY<STRUCT<{_ddl(fields)}>>, _corrupt STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def derive_event_id(table: Column, lsn: Column, tx_id: Column) -> Column:
    """``<table>-<lsn>-<txId>``: the same row change always gets the same id."""
    return F.concat_ws("-", _blank(table), _blank(lsn), F.coalesce(tx_id, F.lit(0)).cast("string"))


def derive_event_time(source_ms: Column, envelope_ms: Column) -> Column:
    """First non-zero of the two epoch-millisecond clocks; null when both are zero."""
    zero = F.lit(0).cast("bigint")
    return F.timestamp_millis(F.coalesce(F.nullif(source_ms, zero), F.nullif(envelope_ms, zero)))


def parse_event_time(value: Column) -> Column:
    """RFC 3339 text to timestamp; the zero instant, however it is spelled, and blank text give null."""
    return F.nullif(F.when(value.rlike(RFC3339), value.try_cast("timestamp")), F.lit(ZERO_TIME).cast("timestamp"))


def normalize_lsn(lsn: Column, is_null: Column) -> Column:
    """Log position as text: number or quoted text; absent gives '', JSON null gives '0'."""
    return F.coalesce(lsn, F.when(is_null, F.lit("0")).otherwise(F.lit("")))


def promote_key(after: Column, before: Column, column: str) -> Column:
    """Business key of a Debezium message: from the after row, else from the before row as a whole."""
    return _blank(F.when(after.isNotNull(), after[column]).otherwise(before[column]))


def probe_envelope(event_id: Column, has_source: Column) -> Column:
    """Debezium when ``event_id`` is blank and a ``source`` key exists, else canonical."""
    return F.when((_blank(event_id) == "") & has_source, F.lit(DEBEZIUM)).otherwise(F.lit(CANONICAL))


def decode(log: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """One event row per log row. ``decode_error`` is null for a decodable message.

    Kafka coordinates travel as ``topic, kafka_partition, kafka_offset, key``;
    the raw text stays in ``value`` for the dead-letter table. ``renames`` maps a
    field to the older path to fall back on (dotted, e.g.
    ``{"after.available_qty": "after.qty"}``).
    """
    renames = dict(renames or {})
    fields = _fields(renames)
    value, m = F.col("value"), F.col("_m")

    def at(path: str) -> Column:
        head, _, tail = path.partition(".")
        return m[head][tail] if tail else m[head]

    def leaf(path: str) -> Column:
        return F.coalesce(at(path), at(renames[path])) if path in renames else at(path)

    parsed = log.withColumn("_json", parse(value, fields)).select(
        "*",
        F.get(F.col("_json.v"), F.lit(0)).alias("_m"),
        (F.coalesce(F.size("_json.v"), F.lit(-1)) != 1).alias("_not_one"),
        F.col("_json._corrupt").isNotNull().alias("_corrupt"),
    )
    # A present but null source also means Debezium; only a message with neither looks at its keys again.
    has_source = m["source"].isNotNull() | F.coalesce(
        F.array_contains(F.json_object_keys(value), "source"), F.lit(False)
    )
    texts = _TEXT_IN_BOTH + _TEXT_IN_CANONICAL + _TEXT_IN_DEBEZIUM
    looks_odd = F.concat_ws("\n", *[leaf(p) for p in texts if p != "source.lsn"]).rlike(_TOKEN_LINE)
    probed = parsed.select(
        "*",
        (probe_envelope(leaf("event_id"), has_source) == DEBEZIUM).alias("_debezium"),
        (looks_odd | (m["source"].isNotNull() & leaf("source.lsn").isNull())
         | ((_blank(leaf("event_id")) != "") & F.coalesce(leaf("source.lsn").rlike(_TOKEN_LINE), F.lit(False)))
         ).alias("_suspect"),
    ).withColumn("_doc", F.when(F.col("_suspect"), F.try_parse_json(value)))
    debezium, doc = F.col("_debezium"), F.col("_doc")

    def wrong_text(paths: list[str]) -> Column:
        every = paths + [renames[p] for p in paths if p in renames]
        return _any([V.not_text(doc, p) for p in every])

    event_time = leaf("event_time")
    bad_time = event_time.isNotNull() & (~event_time.rlike(RFC3339) | event_time.try_cast("timestamp").isNull())
    # The canonical shape has no ts_ms, so there a wrong ts_ms alone is no error.
    without_ts = {k: v for k, v in fields.items() if k != "ts_ms"}
    corrupt = F.when(
        F.col("_corrupt"), debezium | parse(value, without_ts)["_corrupt"].isNotNull()
    ).otherwise(F.lit(False))
    wrong_type = (
        corrupt
        | F.when(
            F.col("_suspect"),
            wrong_text(_TEXT_IN_BOTH)
            | F.when(debezium, wrong_text(_TEXT_IN_DEBEZIUM)).otherwise(wrong_text(_TEXT_IN_CANONICAL)),
        ).otherwise(F.lit(False))
        | (~debezium & bad_time)
    )
    error = (
        F.when(value.isNull() | (F.length(value) == 0), F.lit(EMPTY_PAYLOAD))
        .when((m.isNull() & F.col("_corrupt")) | F.col("_not_one"), F.lit(MALFORMED))
        .when(wrong_type, F.lit(WRONG_TYPE))
        .when(debezium & m["before"].isNull() & m["after"].isNull(), F.lit(NO_ROW))
    )
    flagged = probed.withColumn("decode_error", error)

    def valid(out: Column) -> Column:
        return F.when(F.col("decode_error").isNull(), out)

    def by_shape(if_debezium: Column, if_canonical: Column) -> Column:
        return valid(F.when(debezium, if_debezium).otherwise(if_canonical))

    zero = F.lit(0).cast("bigint")

    def number(path: str) -> Column:
        return F.coalesce(leaf(path), zero)

    def row(side: str) -> Column:
        return F.when(
            m[side].isNotNull(),
            F.struct(
                number(f"{side}.available_qty").alias("available_qty"),
                number(f"{side}.reserved_qty").alias("reserved_qty"),
                _blank(leaf(f"{side}.stock_status")).alias("stock_status"),
                number(f"{side}.row_version").alias("row_version"),
            ),
        )

    table = _blank(leaf("source.table"))
    lsn = normalize_lsn(leaf("source.lsn"), F.when(F.col("_suspect"), V.is_null_leaf(doc, "source.lsn")))
    # One event per message, through a generator: a filter on a decoded column stays above
    # it, so the optimizer never copies the whole decode into a predicate.
    event = F.struct(
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "key",
        "value",
        F.col("timestamp").alias("log_ts"),
        "decode_error",
        by_shape(F.lit(DEBEZIUM), F.lit(CANONICAL)).alias("envelope"),
        by_shape(derive_event_id(table, lsn, number("source.txId")), _blank(leaf("event_id"))).alias("event_id"),
        by_shape(
            derive_event_time(number("source.ts_ms"), number("ts_ms")), parse_event_time(event_time)
        ).alias("event_time"),
        valid(
            F.struct(
                _blank(leaf("source.db")).alias("db"),
                table.alias("table"),
                _blank(leaf("source.schema")).alias("schema"),
                F.when(debezium, lsn).otherwise(_blank(leaf("source.lsn"))).alias("lsn"),
                number("source.ts_ms").alias("ts_ms"),
                number("source.txId").alias("tx_id"),
            )
        ).alias("source"),
        valid(_blank(leaf("op"))).alias("op"),
        by_shape(promote_key(m["after"], m["before"], "product_id"), _blank(leaf("product_id"))).alias("product_id"),
        by_shape(promote_key(m["after"], m["before"], "warehouse_id"), _blank(leaf("warehouse_id"))).alias(
            "warehouse_id"
        ),
        valid(row("before")).alias("before"),
        valid(row("after")).alias("after"),
        by_shape(F.lit(model.DEBEZIUM_SCHEMA_VERSION), _blank(leaf("schema_version"))).alias("schema_version"),
    )
    return flagged.select(F.inline(F.array(event)))


def latest_row(op: Column, before: Column, after: Column) -> Column:
    """Post-event image: the before row of a delete, the after row of anything else."""
    return F.when(op == model.OP_DELETE, before).otherwise(after)


def projection_defaults(events: DataFrame) -> DataFrame:
    """Events with the image to project flattened out and its defaults filled in.

    Blank status becomes ACTIVE; a zero event time becomes the log time, so the
    result depends on the input only. ``has_image`` is false when there is no
    image to project (an error at projection time).
    """
    row = latest_row(F.col("op"), F.col("before"), F.col("after"))
    return events.select(
        "*",
        row.isNotNull().alias("has_image"),
        row["available_qty"].alias("available_qty"),
        row["reserved_qty"].alias("reserved_qty"),
        F.coalesce(F.nullif(row["stock_status"], F.lit("")), F.lit(model.DEFAULT_STOCK_STATUS)).alias("stock_status"),
        row["row_version"].alias("row_version"),
        F.coalesce(F.col("event_time"), F.col("log_ts")).alias("commit_ts"),
    )
