"""Every query of the transit engine against its oracle on the smallest tables."""

from __future__ import annotations

import pytest

from compare import assert_same, connect
from stoptide.plans import load_catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(load_catalog()))
def test_query(spark, con, name):
    q = load_catalog()[name]
    assert q.sql, "every query of the transit engine has an oracle"
    assert_same(q.build(spark, SF), con, q.sql)


def test_invariants_hold(spark):
    catalog = load_catalog()
    assert all(r["violations"] == 0 for r in catalog["consistency_checks"].build(spark, SF).collect())
    known = {"every trip has stop events", "non-final has status"}
    found = {r["check_name"]: r["violations"] for r in catalog["hard_checks"].build(spark, SF).collect()}
    assert all(n == 0 for name, n in found.items() if name not in known)
    assert found["non-final has status"] == 108


def test_filters_and_columns_reach_the_scan(spark):
    plan = load_catalog()["scan_filter_project"].build(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(l_quantity" in plan
    assert "l_extendedprice" not in plan
