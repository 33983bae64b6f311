import json

import pytest
from helpers import log_of, message

from changeflow.functions.decode import decode
from changeflow.operators import gates
from changeflow.operators.contract import (
    Contract,
    contract_types,
    load_contract,
    schema_guard,
    unknown_fields,
    warn_unknown,
)
from pyspark.sql import functions as F

SIX = Contract("v3", ["event_id", "op", "product_id", "warehouse_id", "after.available_qty", "after.row_version"])


def gate_of(spark, *values, contract=None, **kw):
    rows = gates.gate(decode(log_of(spark, list(values))), contract, **kw).orderBy("kafka_offset").collect()
    return rows[0] if len(rows) == 1 else rows


def test_good_event(spark):
    e = gate_of(spark, message("a", "P", "W", 1))
    assert (e.dlq_reason, e.schema_decision) == (None, "compatible")


@pytest.mark.parametrize(
    "more, reason, detail",
    [
        ({"event_id": ""}, "missing_required", "missing event_id"),
        ({"op": ""}, "missing_required", "missing op"),
        ({"product_id": ""}, "missing_required", "missing product_id"),
        ({"warehouse_id": None}, "missing_required", "missing warehouse_id"),
        ({"after": None}, "missing_required", "missing after row"),
        ({"event_id": "", "op": ""}, "missing_required", "missing event_id"),
        ({"after": {}}, "schema_breaking", "REQUIRED_FIELD_MISSING:after.row_version"),
        ({"event_time": None}, "schema_breaking", "REQUIRED_FIELD_MISSING:event_time"),
        ({"schema_version": ""}, "schema_breaking", "REQUIRED_FIELD_MISSING:schema_version"),
        ({"after": None, "op": "d", "before": {"row_version": 2}}, "schema_breaking",
         "REQUIRED_FIELD_MISSING:after.available_qty"),
        ({"after": {"available_qty": -1, "row_version": 2}}, "projection_error", "chk_available_qty_nonneg"),
        ({"after": {"reserved_qty": -1, "row_version": 2}}, "projection_error", "chk_reserved_qty_nonneg"),
        ({"after": {"stock_status": "GONE", "row_version": 2}}, "projection_error", "chk_stock_status_known"),
        ({"after": {"available_qty": 3_000_000_000, "row_version": 2}}, "projection_error", "available_qty_int32"),
        ({"product_id": "x" * 101}, "projection_error", "product_id_length"),
        ({"event_id": "x" * 151}, "projection_error", "last_event_id_length"),
    ],
)
def test_dead_letters(spark, more, reason, detail):
    body = json.loads(message("a", "P", "W", 1))
    body.update(more)
    e = gate_of(spark, json.dumps(body))
    assert (e.dlq_reason, e.dlq_detail) == (reason, detail)


def test_version_drift_is_applied_with_a_warning(spark):
    e = gate_of(spark, message("a", "P", "W", 1, schema_version="v2"))
    assert (e.dlq_reason, e.schema_decision, e.schema_field) == (None, "conditional", "schema_version")


def test_contract_asking_for_an_unknown_path_breaks_every_event(spark):
    e = gate_of(spark, message("a", "P", "W", 1), contract=Contract("v3", ["event_id", "after.colour"]))
    assert e.dlq_detail == "REQUIRED_FIELD_MISSING:after.colour"


def test_delete_under_a_contract_that_allows_it(spark):
    lax = Contract("v3", ["event_id"])
    with_row, no_row = gate_of(
        spark,
        json.dumps({"event_id": "a", "op": "d", "product_id": "P", "warehouse_id": "W",
                    "before": {"available_qty": 3, "row_version": 9}}),
        json.dumps({"event_id": "b", "op": "d", "product_id": "P", "warehouse_id": "W"}),
        contract=lax,
    )
    assert with_row.dlq_reason is None and with_row.available_qty == 3
    assert (no_row.dlq_reason, no_row.dlq_detail) == ("projection_error", "no row to project")


def test_six_path_contract(spark):
    verdicts = decode(
        log_of(spark, [message("a", "P", "W", 1), message("b", "", "W", 1), message("c", "P", "W", 1, schema_version="v2")])
    ).select(schema_guard(SIX).alias("v"), "kafka_offset").orderBy("kafka_offset").select("v.*").collect()
    assert [v.decision for v in verdicts] == ["compatible", "breaking", "conditional"]
    assert verdicts[1].field == "product_id" and verdicts[1].contract == "v3"


def test_tombstones(spark):
    values = ["", message("a", "P", "W", 1)]
    kept = gate_of(spark, *values)
    assert kept[0].dlq_reason == "decode_error"
    assert gate_of(spark, *values, ignore_tombstones=True).event_id == "a"


def test_envelope_leaves_blank_fields_out(spark):
    gated = gates.gate(decode(log_of(spark, ["{", message("", "P", "W", 1), message("x", "P", "W", 0)])))
    a, b, c = gates.dlq_envelope(gates.route_dlq(gated)[1]).orderBy("original_offset").collect()
    assert a.event_id is None and b.event_id is None and c.event_id == "x"
    assert a.raw_payload == "{" and a.reason == "decode_error"


def test_validate_constraints(spark):
    table = spark.createDataFrame(
        [("P", "W", -1, 0, "ACTIVE", 0, "e"), ("P", "V", 1, 0, "ODD", 1, "e")],
        "product_id string, warehouse_id string, available_qty int, reserved_qty int, stock_status string, "
        "row_version bigint, last_event_id string",
    )
    found = {r[0]: r[1] for r in gates.validate_constraints(table, gates.website_checks()).collect()}
    assert found["chk_available_qty_nonneg"] == 1 and found["chk_row_version_positive"] == 1
    assert found["chk_stock_status_known"] == 1 and found["product_id_length"] == 0
    assert gates.constraint_violations(table, gates.website_checks()).count() == 2


def test_load_contract(tmp_path):
    c = load_contract()
    assert c.version == "v3" and len(c.required_fields) == 8 and len(c.types) == 9
    yaml = pytest.importorskip("yaml")
    assert yaml
    ok = tmp_path / "c.yaml"
    ok.write_text("version: v4\nrequired_fields: [event_id]\n")
    assert load_contract(ok).version == "v4"
    for text, what in [("required_fields: [a]", "no version"), ("version: v1", "no required_fields"), ("a: [", "parse")]:
        bad = tmp_path / "bad.yaml"
        bad.write_text(text)
        with pytest.raises(ValueError, match=what):
            load_contract(bad)
    with pytest.raises(FileNotFoundError):
        load_contract(tmp_path / "none.json")


def test_declared_types_and_unknown_fields(spark):
    log = log_of(
        spark,
        [message("a", "P", "W", 1), message("a", "P", "W", 1, after={"available_qty": "5", "row_version": 2.5}, zebra=1, ant=2)],
    )
    a, b = contract_types(log, load_contract()).orderBy("offset").collect()
    assert a.type_errors == [] and sorted(b.type_errors) == ["after.available_qty", "after.row_version"]
    a, b = unknown_fields(log).orderBy("offset").collect()
    assert a.unknown_fields == [] and b.unknown_fields == ["ant", "zebra"]
    verdict = F.struct(F.lit("compatible").alias("decision"), F.lit(None).cast("string").alias("reason"),
                       F.lit(None).cast("string").alias("field"), F.lit("v3").alias("contract"))
    out = unknown_fields(log).select(warn_unknown(verdict, F.col("unknown_fields"), load_contract()).alias("v"), "offset")
    assert [r.v.decision for r in out.orderBy("offset").collect()] == ["compatible", "conditional"]


def test_switches_are_off_by_default_and_act_when_on(spark):
    typed = Contract("v3", SIX.required_fields, types={"after.available_qty": "int"}, allow_unknown_optional=True)
    big, extra = message("a", "P", "W", 1, qty=3_000_000_000), message("a", "P", "W", 1, colour="red")
    assert gate_of(spark, big, contract=typed).dlq_reason == "projection_error"
    e = gate_of(spark, big, contract=typed, check_types=True)
    assert (e.dlq_reason, e.dlq_detail) == ("schema_breaking", "FIELD_TYPE_MISMATCH:after.available_qty")
    assert gate_of(spark, extra, contract=typed).schema_decision == "compatible"
    e = gate_of(spark, extra, contract=typed, warn_unknown_fields=True, check_types=True)
    assert (e.dlq_reason, e.schema_decision, e.schema_field) == (None, "conditional", "colour")


def test_constraints_are_compiled(spark):
    """No lambda, which Spark would interpret row by row."""
    gated = gates.gate(decode(log_of(spark, [message("a", "P", "W", 1)])))
    assert "lambda" not in gated._jdf.queryExecution().executedPlan().toString()


def test_all_broken_constraints_are_named(spark):
    e = gate_of(spark, message("a", "P" * 500, "W", 1, qty=-1))
    assert (e.dlq_reason, e.dlq_detail) == ("projection_error", "chk_available_qty_nonneg,product_id_length")
