import os
import sys

import pytest

pytest.importorskip("changeflow.llm")
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import compare as C  # noqa: E402

from changeflow.llm.oracles import oracles  # noqa: E402


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_agrees_with_its_sql(spark, small_dir, name):
    assert C.compare(spark, C.connect(small_dir), name, small_dir)[0] == ""
