"""Versioned schema contracts, compiled into column expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model
from changeflow.functions.variant import json_type

REQUIRED_FIELD_MISSING = "REQUIRED_FIELD_MISSING"
SCHEMA_VERSION_DRIFT = "SCHEMA_VERSION_DRIFT"

DEFAULT_CONTRACT = Path(__file__).resolve().parent.parent / "contracts" / "inventory.v3.json"


@dataclass(frozen=True)
class Contract:
    version: str
    required_fields: Sequence[str]
    types: Mapping[str, str] = field(default_factory=dict)
    allow_unknown_optional: bool = False
    mapping: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.version:
            raise ValueError("contract has no version")
        if not self.required_fields:
            raise ValueError("contract has no required_fields")


def load_contract(path: str | Path = DEFAULT_CONTRACT) -> Contract:
    """Read one contract document: JSON, or YAML where PyYAML is installed."""
    path = Path(path)
    text = path.read_text()
    if path.suffix in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as exc:
            raise ValueError(f"{path}: YAML contracts need PyYAML; use the JSON form") from exc
        try:
            doc = yaml.safe_load(text)
        except yaml.YAMLError as exc:
            raise ValueError(f"parse contract {path}: {exc}") from exc
    else:
        try:
            doc = json.loads(text)
        except json.JSONDecodeError as exc:
            raise ValueError(f"parse contract {path}: {exc}") from exc
    doc = doc or {}
    try:
        return Contract(
            version=doc.get("version") or "",
            required_fields=tuple(doc.get("required_fields") or ()),
            types=dict(doc.get("types") or {}),
            allow_unknown_optional=bool(doc.get("allow_unknown_optional", False)),
            mapping=dict(doc.get("mapping") or {}),
        )
    except ValueError as exc:
        raise ValueError(f"contract {path}: {exc}") from exc


def field_present(path: str) -> Column:
    """Presence test of one contract path; a path nobody can check is never present."""
    if path in ("event_id", "op", "product_id", "warehouse_id", "schema_version"):
        return F.coalesce(F.col(path) != "", F.lit(False))
    if path == "event_time":
        return F.col("event_time").isNotNull()
    if path == "after.available_qty":
        return F.col("after").isNotNull()
    if path == "after.row_version":
        return F.coalesce(F.col("after.row_version") > 0, F.lit(False))
    return F.lit(False)


def schema_guard(contract: Contract) -> Column:
    """``struct<decision, reason, field, contract>`` of a decoded event."""

    def verdict(decision: str, reason: str | None = None, name: str | None = None) -> Column:
        return F.struct(
            F.lit(decision).alias("decision"),
            F.lit(reason).cast("string").alias("reason"),
            F.lit(name).cast("string").alias("field"),
            F.lit(contract.version).alias("contract"),
        )

    first, *rest = contract.required_fields
    checks = F.when(~field_present(first), verdict(model.BREAKING, REQUIRED_FIELD_MISSING, first))
    for path in rest:
        checks = checks.when(~field_present(path), verdict(model.BREAKING, REQUIRED_FIELD_MISSING, path))
    drift = F.coalesce((F.col("schema_version") != "") & (F.col("schema_version") != contract.version), F.lit(False))
    return checks.when(
        drift, verdict(model.CONDITIONAL, SCHEMA_VERSION_DRIFT, "schema_version")
    ).otherwise(verdict(model.COMPATIBLE))


# JSON types a declared contract type accepts.
_ACCEPTED = {"string": ["STRING"], "int": ["BIGINT"], "long": ["BIGINT"]}


def contract_types(df: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """Add ``type_errors``: contract paths whose JSON leaf has another type than declared.

    The contract declares these types but the gate does not act on them; this is
    the check for those who want it. Absent and null leaves are no error.
    """
    parsed = df.withColumn("_typed", F.try_parse_json(F.col(value)))
    found = []
    for path, declared in contract.types.items():
        kind = json_type(F.col("_typed"), path)
        allowed = kind.isin("VOID", *_ACCEPTED[declared])
        if declared == "int":
            number = F.try_variant_get(F.col("_typed"), f"$.{path}", "int")
            allowed = (kind == "VOID") | ((kind == "BIGINT") & number.isNotNull())
        found.append(F.when(kind.isNotNull() & ~allowed, F.lit(path)))
    return parsed.withColumn("type_errors", F.array_compact(F.array(*found))).drop("_typed")


def refuse_types(verdict: Column, type_errors: Column, contract: Contract) -> Column:
    """Turn a verdict that isn't breaking into a breaking one where a leaf has another type than declared."""
    return F.when(
        (verdict["decision"] != model.BREAKING) & (F.size(type_errors) > 0),
        F.struct(
            F.lit(model.BREAKING).alias("decision"),
            F.lit("FIELD_TYPE_MISMATCH").alias("reason"),
            F.get(type_errors, F.lit(0)).alias("field"),
            F.lit(contract.version).alias("contract"),
        ),
    ).otherwise(verdict)


# --- fixed values: top-level keys of the two envelopes ------------------------------------
KNOWN_KEYS = [
    "event_id", "event_time", "source", "op", "product_id", "warehouse_id", "before", "after", "schema_version",
    "ts_ms",
]


def unknown_fields(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``unknown_fields``: top-level keys outside the event schema, sorted."""
    keys = F.coalesce(F.json_object_keys(F.col(value)), F.array().cast("array<string>"))
    known = F.array(*[F.lit(k) for k in KNOWN_KEYS])
    return df.withColumn("unknown_fields", F.array_sort(F.array_except(keys, known)))


def warn_unknown(verdict: Column, unknown: Column, contract: Contract) -> Column:
    """Turn a compatible verdict into a conditional one when optional unknown fields are let through."""
    if not contract.allow_unknown_optional:
        return verdict
    return F.when(
        (verdict["decision"] == model.COMPATIBLE) & (F.size(unknown) > 0),
        F.struct(
            F.lit(model.CONDITIONAL).alias("decision"),
            F.lit("UNKNOWN_OPTIONAL_FIELD").alias("reason"),
            F.get(unknown, F.lit(0)).alias("field"),
            F.lit(contract.version).alias("contract"),
        ),
    ).otherwise(verdict)
