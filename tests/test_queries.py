"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from fleetlens.plans import queries as plans
from tests.oracle import compare, connect

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_of_the_plans_has_a_counterpart():
    assert set(plans.QUERIES) == set(plans.ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert 0 < len(rows) <= 20
    peaks = [r.peak_cpu_percent for r in rows]
    assert peaks == sorted(peaks, reverse=True)
