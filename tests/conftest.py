from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewheel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tidewheel-tests-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tidewheel-warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tidewheel-case-")


def bag(df, *columns):
    """Sorted rows as tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    rows = [tuple(r) for r in picked.collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
