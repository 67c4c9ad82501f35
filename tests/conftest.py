from __future__ import annotations

import os

import pytest

from reviewlake.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture
def lake(tmp_path) -> str:
    """A folder of its own for every test."""
    return str(tmp_path)


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
