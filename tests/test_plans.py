"""Shape of the physical plans."""

from __future__ import annotations

import re

import pytest

from ballast.operators.ladder import ladder_span, latest_state, state_history
from ballast.plans import catalog
from ballast.sources import tables
from tests.conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["beta_stress", "grid_pnl", "all_scenarios", "firm_stress", "shocked_prices", "ladder_combined"])
def test_scenarios_need_no_join(spark, name):
    text = plan(catalog.BATCH[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_python_in_any_plan(spark):
    skipped = {"backtest_replay", "audit_scan_pruned", "audit_retained"}  # these write files first
    for name, query in catalog.BATCH.items():
        if name not in skipped:
            text = plan(query(spark, SF))
            assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|NestedLoop", text), name


def test_rank_limit_before_the_shuffle(spark):
    text = plan(catalog.BATCH["latest_price_rn"](spark, SF))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange.*WindowGroupLimit.*Partial", text, re.S)


def test_partial_aggregation_and_pruned_scan(spark):
    text = plan(catalog.BATCH["net_positions"](spark, SF))
    assert "partial_sum" in text
    schema = re.search(r"lineitem.parquet.*?ReadSchema: (\S+)", text).group(1)
    assert "l_extendedprice" not in schema and "l_comment" not in schema
    assert "part.parquet" not in text  # positions take nothing from parts


def test_filter_reaches_the_scan(spark):
    text = plan(catalog.BATCH["latest_beta"](spark, SF))
    assert re.search(r"lineitem.parquet.*?PushedFilters: \[IsNotNull\(l_partkey\)", text)


def test_positions_meet_their_marks_in_one_join(spark, no_broadcast):
    text = plan(catalog.BATCH["account_margin"](spark, SF))
    # line items x2, orders, parts x2 (price, beta), positions, marks x2, accounts
    assert text.count("Exchange hashpartitioning") <= 11
    assert len(re.findall(r"SortMergeJoin \[symbol#\d+L?, _salt", text)) == 1


def test_weights_reuse_the_valued_positions(spark, no_broadcast):
    df = catalog.BATCH["position_weights"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def spread_for_all(text: str) -> list[str]:
    """Places of a plan where every key of a lookup is multiplied by the salts, not only hot ones."""
    return [line for line in text.split("\n") if re.search(r"Generate explode.*_salt", line) and "_hot" not in line]


@pytest.mark.parametrize("stress", [False, True])
def test_first_moments_of_all_accounts_are_not_multiplied(spark, no_broadcast, stress):
    events = tables.margin_events(spark, SF)
    known = latest_state(state_history(ladder_span(events, stress=stress)))
    for prior in (None, known):
        assert not spread_for_all(plan(ladder_span(events, stress=stress, prior=prior)))


def test_symbols_of_displayed_events_are_not_multiplied(spark, no_broadcast):
    assert not spread_for_all(plan(catalog.event_display_line(spark, SF)))


def test_a_message_is_parsed_once(spark):
    text = catalog.BATCH["decode_events"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1 and "try_parse_json" not in text
