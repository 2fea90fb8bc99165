"""Every registered query with a SQL twin, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registry
from ballast.plans import catalog, oracle, streams
from check import TABLES, canonical
from tests.conftest import SF

STATEMENTS = registry.oracle_sql()
QUERIES = registry.queries()
#: The library's own queries, without those of the subpackage that may be missing.
OWN = {**catalog.BATCH, **streams.STREAMS}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_registered_names_agree():
    assert set(STATEMENTS) <= set(QUERIES)
    assert set(OWN) - set(oracle.statements()) == {"liquidation_orders"}


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(STATEMENTS[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_orders_hold_the_selected_lines(spark):
    lines = QUERIES["liquidation_selection"](spark, SF)
    orders = QUERIES["liquidation_orders"](spark, SF)
    flat = orders.selectExpr("account_id", "inline(positions)")
    pick = lambda df: sorted((r.account_id, r.symbol, r.qty, r.estimated_proceeds) for r in df.collect())
    assert pick(flat) == pick(lines)


def test_branch_coverage_of_the_tables(spark, con):
    """Every standing and every step of the ladder occurs in the tables."""
    standing = {r.standing for r in QUERIES["account_standing"](spark, SF).select("standing").distinct().collect()}
    assert standing == {"DEFICIENT", "WARNING", "GOOD"}
    kinds = {r.event_type: r.events for r in QUERIES["audit_counts"](spark, SF).collect()}
    assert set(kinds) == {"WARNING_ISSUED", "MARGIN_CALL_ISSUED", "RESTRICTION_APPLIED", "LIQUIDATION_TRIGGERED"}
    assert kinds == dict(con.execute(STATEMENTS["audit_counts"]).fetchall())


def test_deficient_snapshots_fail_a_severe_stress(spark):
    """Hence, with both feeds, restriction never waits for the call to grow stale."""
    acts = QUERIES["ladder_combined"](spark, SF)
    assert acts.filter("event_type in ('RESTRICTION_APPLIED', 'LIQUIDATION_TRIGGERED')").count() == 0


def test_entry_runs(spark):
    assert registry.entry(spark).count() == 150 * 8
