"""Registered queries against their reference SQL at the smallest scale."""

from __future__ import annotations

import inspect

import pytest

import __spark_entry__ as entry
from fathomline.operators import regress
from fathomline.operators.sampling import sample_rows
from fathomline.plans import catalog, oracle
from fathomline.sources import given
from tests.compare import database, difference, spark_rows, sql_rows, type_difference

QUERIES, ORACLES = catalog.QUERIES, oracle.ORACLES
ROWS_ONLY = ["trained_classify"]


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_only_learned_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == set(ROWS_ONLY)
    assert set(ORACLES) <= set(QUERIES)


SEARCHES = ["regressor_scores", "model_roundtrip", "price_run"]


@pytest.mark.parametrize("name", SEARCHES)
def test_search_query(spark, sf, con, monkeypatch, name):
    """The searches with fewer rounds; tests/compare.py runs them whole."""
    monkeypatch.setitem(regress.FULL_GRID, "maxIter", [3, 6])
    df = QUERIES[name](spark, sf)
    assert difference(spark_rows(df), sql_rows(con, ORACLES[name])) is None
    assert type_difference(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(SEARCHES)))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert difference(spark_rows(df), sql_rows(con, ORACLES[name])) is None
    assert type_difference(df, con, ORACLES[name]) is None


def test_smoke_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_sample_does_not_depend_on_the_layout(spark, sf):
    bars = given.prices(spark, sf)
    kept = sample_rows(bars, 0.5, ["symbol", "date"]).select("symbol", "date")
    again = sample_rows(bars.repartition(3), 0.5, ["symbol", "date"]).select("symbol", "date")
    assert kept.exceptAll(again).count() == again.exceptAll(kept).count() == 0
    assert 0.4 < kept.count() / bars.count() < 0.6


def test_no_collected_frames_in_the_library():
    assert "toPandas" not in inspect.getsource(catalog)


@pytest.mark.parametrize("name", ["lookback_filter", "latest_stats", "backtest", "actual_vs_predicted"])
def test_date_bounds_reach_the_scan(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan
