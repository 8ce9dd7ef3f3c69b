"""Every registered query against the second engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from haulbook.operators import joins, members
from haulbook.queries import QUERIES
from oracle_checks import oracle_queries
from oracle_checks.compare import connect, difference, oracle_rows, spark_rows

ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) == 39
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small, con, name):
    ours = spark_rows(QUERIES[name](spark, small))
    assert ours[1].total() > 0
    assert difference(ours, oracle_rows(con, ORACLE[name])) is None


@pytest.mark.parametrize(
    "name",
    "accounts_model carriers_model drivers_model route_templates dimension_enrich existence_flag parent_lookup eta_ontime "
    "composite_key_join driver_scorecard".split(),
)
def test_query_with_every_key_hot(spark, small, con, name, monkeypatch, shuffled_joins):
    """The same results when keys with several matches are split and every join shuffles."""
    monkeypatch.setattr(joins, "ROWS_PER_SLOT", 2)
    monkeypatch.setattr(joins, "COPIES_PER_PIECE", 1)
    monkeypatch.setattr(joins, "BYTES_PER_ROW", 0)
    monkeypatch.setattr(members, "FILTER_FROM", 0)
    ours = spark_rows(QUERIES[name](spark, small))
    assert difference(ours, oracle_rows(con, ORACLE[name])) is None


def test_queries_in_another_time_zone(spark, small, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("latest_per_key", "rolling_lookback", "active_route_driver"):
            ours = spark_rows(QUERIES[name](spark, small))
            assert difference(ours, oracle_rows(con, ORACLE[name])) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert entry.entry(spark).count() == 10
