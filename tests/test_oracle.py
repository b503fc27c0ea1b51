"""Every registered query against its SQL, and no plan that pairs all rows."""

from __future__ import annotations

import os

import pytest

from tests.oracle import connect, differences
from tidewheel.plans import ORACLES, QUERIES

BASE = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(BASE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, BASE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
