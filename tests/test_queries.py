"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from reviewlake.checks.registry import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_rows_with_a_stable_schema(spark):
    df = entry(spark)
    assert df.columns == ["review_year", "review_month", "review_version", "segment", "service_type",
                          "app_reference", "review_count", "average_rating", "min_rating",
                          "max_rating", "nps_score"]
    assert not df.isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, con, ORACLES[name]) == ""
    plan = plan_of(df)
    for operator in ("PythonUDF", "ArrowEval", "MapInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin", "RoundRobinPartitioning"):
        assert operator not in plan
