"""Queries that SQL can express, against their SQL twins; all others are tested in their own modules."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from reviewlake.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import plan_of

NATIVE = ("op1_license_scan", "op2_url_filter", "op4_mix_sources")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert node not in plan
