"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import oracle_check
from contract.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SLOW = {"fare_predictions"}


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_sql(spark, connection, name):
    ok, note = oracle_check.compare(spark, connection, name, QUERIES, ORACLES, SF)
    assert ok is not False, note


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["temp_category", "wind_category", "trip_count", "avg_distance_miles"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
