"""Queries with a SQL form against that SQL, and their registration."""

from __future__ import annotations

import pytest

import __spark_entry__
from tests.oracle import connect, differences
from tidewheel.llm.queries import ORACLES, QUERIES

BASE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, BASE), connect(BASE), ORACLES[name]) is None


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)
