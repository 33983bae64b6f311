"""Gates between the log and the read model, and the dead-letter branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model
from changeflow.functions.decode import projection_defaults
from changeflow.operators.contract import Contract, contract_types, load_contract, refuse_types, schema_guard, unknown_fields, warn_unknown


def required_fields() -> Column:
    """First structural fault of a decoded event as text, or null."""

    def blank(name: str) -> Column:
        return F.coalesce(F.col(name) == "", F.lit(True))

    return (
        F.when(blank("event_id"), F.lit("missing event_id"))
        .when(blank("op"), F.lit("missing op"))
        .when(blank("product_id"), F.lit("missing product_id"))
        .when(blank("warehouse_id"), F.lit("missing warehouse_id"))
        .when((F.col("op") != model.OP_DELETE) & F.col("after").isNull(), F.lit("missing after row"))
    )


def website_checks(event_id: str = "last_event_id") -> dict[str, Column]:
    """Violation test per constraint of the read model; every test is true or false, never null."""

    def fails(condition: Column) -> Column:
        return F.coalesce(~condition, F.lit(False))

    checks = {
        "chk_available_qty_nonneg": fails(F.col("available_qty") >= 0),
        "chk_reserved_qty_nonneg": fails(F.col("reserved_qty") >= 0),
        "chk_row_version_positive": fails(F.col("row_version") > 0),
        "chk_stock_status_known": fails(F.col("stock_status").isin(model.STOCK_STATUSES)),
    }
    for name in ("available_qty", "reserved_qty"):
        checks[f"{name}_int32"] = fails(
            (F.col(name) <= model.INT32_MAX) & (F.col(name) >= -model.INT32_MAX - 1)
        )
    for column, limit in model.MAX_LENGTH.items():
        name = event_id if column == "last_event_id" else column
        checks[f"{column}_length"] = fails(F.length(name) <= limit)
        checks[f"{column}_not_null"] = F.col(name).isNull()
    for column in ("available_qty", "reserved_qty", "row_version"):
        checks[f"{column}_not_null"] = F.col(column).isNull()
    return checks


def warehouse_checks() -> dict[str, Column]:
    return {"chk_warehouse_available_qty_nonneg": F.coalesce(F.col("available_qty") < 0, F.lit(False))}


def _broken(checks: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]))


def constraint_violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break at least one check, with the list of broken checks."""
    return df.withColumn("violations", _broken(checks)).filter(F.size("violations") > 0)


def validate_constraints(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Violation count per check over a whole table, zeros included."""
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])
    return counts.unpivot([], list(checks), "constraint_name", "violations")


def gate(
    decoded: DataFrame,
    contract: Contract | None = None,
    ignore_tombstones: bool = False,
    check_types: bool = False,
    warn_unknown_fields: bool = False,
) -> DataFrame:
    """Decoded events tagged with ``dlq_reason`` / ``dlq_detail`` (null = passes) and the guard's verdict.

    Order: decode, required fields, contract, projection. An event that the read
    model's constraints would refuse is a ``projection_error``: a property of
    the event, so it goes to the dead letters rather than stopping the stream.

    Off by default: ``check_types`` makes a leaf of another type than the contract
    declares breaking; ``warn_unknown_fields`` makes an otherwise compatible event
    with an unknown top-level field conditional, if the contract lets such fields through.
    """
    contract = contract or load_contract()
    if ignore_tombstones:
        decoded = decoded.filter(F.coalesce(F.length("value"), F.lit(0)) > 0)
    rows, judged = projection_defaults(decoded), schema_guard(contract)
    if warn_unknown_fields:
        rows = unknown_fields(rows)
        judged = warn_unknown(judged, F.col("unknown_fields"), contract)
    if check_types:
        rows = contract_types(rows, contract)
        judged = refuse_types(judged, F.col("type_errors"), contract)
    tagged = rows.select(
        "*",
        F.when(F.col("decode_error").isNull(), required_fields()).alias("_missing"),
        F.when(F.col("decode_error").isNull(), judged).alias("_verdict"),
    )
    verdict = F.col("_verdict")
    detail = F.concat_ws(":", verdict["reason"], verdict["field"])
    # Text instead of a list: it compiles, and the names hold no comma.
    refused = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in website_checks(event_id="event_id").items()])
    reached_guard = F.col("decode_error").isNull() & F.col("_missing").isNull()
    reached_table = reached_guard & (verdict["decision"] != model.BREAKING)
    tagged = tagged.select(
        "*",
        F.when(reached_table, F.when(F.col("has_image"), refused).otherwise(F.lit("no row to project"))).alias(
            "_refused"
        ),
    )
    failed_projection = F.coalesce(F.col("_refused"), F.lit("")) != ""
    reason = (
        F.when(F.col("decode_error").isNotNull(), F.lit(model.DECODE_ERROR))
        .when(F.col("_missing").isNotNull(), F.lit(model.MISSING_REQUIRED))
        .when(verdict["decision"] == model.BREAKING, F.lit(model.SCHEMA_BREAKING))
        .when(failed_projection, F.lit(model.PROJECTION_ERROR))
    )
    why = (
        F.when(F.col("decode_error").isNotNull(), F.col("decode_error"))
        .when(F.col("_missing").isNotNull(), F.col("_missing"))
        .when(verdict["decision"] == model.BREAKING, detail)
        .when(failed_projection, F.col("_refused"))
    )
    return tagged.select(
        *decoded.columns,
        "available_qty",
        "reserved_qty",
        "stock_status",
        "row_version",
        "commit_ts",
        reason.alias("dlq_reason"),
        why.alias("dlq_detail"),
        F.when(reached_guard, verdict["decision"]).alias("schema_decision"),
        F.when(reached_guard, verdict["field"]).alias("schema_field"),
    )


def route_dlq(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events that pass, dead letters)."""
    return gated.filter(F.col("dlq_reason").isNull()), gated.filter(F.col("dlq_reason").isNotNull())


def dlq_envelope(dead: DataFrame) -> DataFrame:
    """Dead letters as rows of the stable envelope; a blank id or detail is left out (null)."""
    return dead.select(
        F.col("topic").alias("original_topic"),
        F.col("kafka_partition").alias("original_partition"),
        F.col("kafka_offset").alias("original_offset"),
        # A message that could not be decoded has no id to report.
        F.nullif(F.col("event_id"), F.lit("")).alias("event_id"),
        F.col("dlq_reason").alias("reason"),
        F.nullif(F.col("dlq_detail"), F.lit("")).alias("reason_detail"),
        F.col("log_ts").alias("first_failed_at"),
        F.coalesce(F.col("value"), F.lit("")).alias("raw_payload"),
        "key",
    )
