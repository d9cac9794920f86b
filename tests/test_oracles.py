"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from hazardbook.bindings import all_oracles, all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()
# Lookups of one fixed key that the smallest tables do not hold.
MAY_BE_EMPTY = {
    "advisories_of_record", "exploits_of_record", "live_known_exploited", "technique_users",
    "find_candidates", "compound_filter", "partial_decision_lookup", "point_lookup",
    "patterns_of_weakness",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, SF_DIR, QUERIES[name], ORACLES[name])
    if name in MAY_BE_EMPTY and problem == "both empty":
        problem = None
    assert problem is None, problem


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
