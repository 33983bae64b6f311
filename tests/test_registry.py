import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import compare as C  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from changeflow.plans.oracles import oracles as oracle_sql  # noqa: E402
from changeflow.plans.queries import registered as queries  # noqa: E402


def test_every_query_has_its_oracle():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark, small_dir):
    out = {(r.result, r.reason): r.events for r in entry(spark).collect()}
    assert out == {
        ("applied", None): 549, ("rejected", None): 223, ("skipped", None): 17, ("dlq", "decode_error"): 11,
        ("dlq", "missing_required"): 12, ("dlq", "schema_breaking"): 211,
    }


@pytest.fixture(scope="module")
def duck(small_dir):
    return C.connect(small_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_agrees_with_its_oracle(spark, duck, small_dir, name):
    message, _, _ = C.compare(spark, duck, name, small_dir)
    assert message == ""


def test_library_has_no_row_at_a_time_python():
    banned = re.compile(r"\bF\.udf\b|pandas_udf|\.rdd\b|localCheckpoint|toPandas|crossJoin")
    for folder, _, files in os.walk(os.path.join(ROOT, "changeflow")):
        if "llm" in os.path.relpath(folder, ROOT).split(os.sep):
            continue
        for f in files:
            if f.endswith(".py"):
                assert not banned.search(open(os.path.join(folder, f)).read()), f
