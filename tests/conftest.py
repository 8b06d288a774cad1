from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from subledger.session import build_session  # noqa: E402
from subledger.settings import Settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false", spark__log__level="ERROR",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def settings():
    return Settings(as_of=dt.datetime(2025, 6, 30))


@pytest.fixture(scope="session")
def rows(spark):
    """DataFrame from a DDL schema and literal rows."""
    return lambda schema, *values: spark.createDataFrame(list(values), schema)
