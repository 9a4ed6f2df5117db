"""Every registered query against its DuckDB oracle (the correctness gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from marketlake import catalog, catalog_events, oracles, oracles_events
from tests.conftest import SF_CHECK, SF_SMALL
from tools.oracle_check import duck, rows_key

QUERIES = catalog.QUERIES | catalog_events.QUERIES
ORACLES = oracles.ORACLES | oracles_events.ORACLES
NAMES = sorted(QUERIES)


def test_every_query_has_oracle_or_is_rows_only():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 951  # (id, dt, hour) groups at sf0.001
    assert "total_registros" in df.columns


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_CHECK)
    rows = [tuple(r) for r in df.collect()]
    sql = entry_mod.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert rows_key(df.columns, rows) == rows_key(dcols, drows)


def _rows(spark, name, *columns):
    return [tuple(r[c] for c in columns) for r in entry_mod.queries()[name](spark, SF_CHECK).collect()]


def test_views_come_in_their_order(spark):
    caps = _rows(spark, "serve_market_cap", "market_cap", "id")
    moves = _rows(spark, "serve_variation", "price_change_percentage_24h", "id")
    assert len(caps) == len(moves) == 20 and caps == sorted(caps) and moves == sorted(moves)
    spreads = _rows(spark, "serve_top_spread", "spread_24h", "id")
    assert len(spreads) == 20 and spreads == sorted(spreads, key=lambda r: (-r[0], r[1]))
    for name in ("serve_hourly_series", "serve_hourly_volume", "serve_hourly_volatility", "serve_default_series"):
        series = _rows(spark, name, "dt", "hour", "id")
        assert len(series) > 100 and series == sorted(series), name
    symbols = _rows(spark, "serve_symbols", "symbol")
    assert symbols == sorted(symbols)
    ranks = _rows(spark, "serve_top_n", "market_cap_rank", "id")
    assert ranks == sorted(ranks, key=lambda r: (r[0] is None, r[0], r[1]))


def test_fixture_counts(spark):
    q = entry_mod.queries()
    assert q["silver_dedup"](spark, SF_CHECK).count() == 8916
    assert q["gold_hourly_fact_ticks"](spark, SF_CHECK).filter("total_registros > 1").count() == 1012
    assert q["maint_vacuum_days"](spark, SF_SMALL).count() == 4
