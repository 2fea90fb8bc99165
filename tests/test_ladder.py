"""The ladder against a sequential state machine, whole and in micro-batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ballast.operators import audit
from ballast.operators.ladder import ladder, latest_state, live_state, state_history, with_state
from ballast.params import DEFAULT

SCHEMA = (
    "account_id STRING, ts TIMESTAMP_NTZ, event_id BIGINT, total_mv DOUBLE, equity DOUBLE, "
    "maintenance_req DOUBLE, excess DOUBLE, beta_weighted_exposure DOUBLE"
)
T0 = datetime(2024, 1, 1, 10)


def event(n, minutes, excess_pct, account="a", mv=1000.0, exposure=None):
    """Snapshot with excess as a share of market value."""
    excess = mv * excess_pct
    req = 0.25 * mv
    return (account, T0 + timedelta(minutes=minutes), n, mv, excess + req, req, excess, mv if exposure is None else exposure)


def walk(events, stress):
    """Plain state machine, one event at a time."""
    state, called, out, wrote = {}, {}, [], {}
    for account, ts, n, mv, equity, req, excess, exposure in sorted(events, key=lambda e: (e[1], e[2])):
        if account in wrote and ts >= wrote[account] + timedelta(days=DEFAULT.state_ttl_days):
            del state[account], wrote[account]
        status = state.get(account, "ACTIVE")
        before = len(out)
        if 0 <= excess < DEFAULT.warning_pct * mv and status == "ACTIVE":
            state[account] = "WARNING"
            out.append((account, ts, n, "WARNING_ISSUED"))
        elif excess < 0 and status in ("ACTIVE", "WARNING"):
            state[account], called[account] = "MARGIN_CALL", ts
            out.append((account, ts, n, "MARGIN_CALL_ISSUED"))
        elif excess < 0 and status == "MARGIN_CALL" and ts - called[account] > timedelta(minutes=30):
            state[account] = "RESTRICTED"
            out.append((account, ts, n, "RESTRICTION_APPLIED"))
            if -excess > 0.5 * req:
                out.append((account, ts, n, "LIQUIDATION_TRIGGERED"))
        if stress and state.get(account) != "RESTRICTED":
            if any(equity + exposure * s - req < 0 for s in DEFAULT.index_scenarios if abs(s) >= 0.06):
                state[account] = "RESTRICTED"
                out.append((account, ts, n, "STRESS_RESTRICTION"))
        if len(out) > before:
            wrote[account] = ts
    return sorted(out)


def run(spark, events, stress=False, prior=None):
    return ladder(spark.createDataFrame(events, SCHEMA), stress=stress, prior=prior)


def taken(df):
    return sorted((r.account_id, r.ts, r.event_id, r.event_type) for r in df.collect())


def test_healthy_account_does_nothing(spark):
    assert taken(run(spark, [event(1, 0, 0.70, mv=100_000.0)], True)) == []


def test_demo_path_takes_no_action(spark):
    path = [
        ("demo", T0 + timedelta(minutes=5 * i), i, 500 * p, 50_000 + 500 * p, 125 * p, 50_000 + 375 * p, 900 * p)
        for i, p in enumerate([400.0, 392.0, 384.0, 368.0, 352.0, 336.0])
    ]
    assert taken(run(spark, path, True)) == []


def test_walk_down_the_ladder(spark):
    events = [event(1, 0, 0.03), event(2, 1, -0.01), event(3, 31, -0.01), event(4, 31 + 1 / 60, -0.20)]
    acts = run(spark, events)
    assert [(n, t) for _, _, n, t in taken(acts)] == [
        (1, "WARNING_ISSUED"),
        (2, "MARGIN_CALL_ISSUED"),
        (4, "LIQUIDATION_TRIGGERED"),
        (4, "RESTRICTION_APPLIED"),
    ]
    by = {r.event_type: r for r in acts.collect()}
    assert by["WARNING_ISSUED"].deficiency is None
    assert by["MARGIN_CALL_ISSUED"].deficiency == pytest.approx(10)
    assert by["RESTRICTION_APPLIED"].elapsed_minutes == pytest.approx(30 + 1 / 60)
    assert by["RESTRICTION_APPLIED"].reason == "Margin call outstanding for 30 minutes"
    assert by["LIQUIDATION_TRIGGERED"].trigger == "SEVERE_DEFICIENCY"
    assert by["LIQUIDATION_TRIGGERED"].correlation_id == by["RESTRICTION_APPLIED"].correlation_id


def test_call_and_stress_restriction_at_one_instant(spark):
    acts = run(spark, [event(1, 0, -0.01), event(2, 60, -0.20)], True)
    assert [(n, t) for _, _, n, t in taken(acts)] == [(1, "MARGIN_CALL_ISSUED"), (1, "STRESS_RESTRICTION")]
    row = {r.event_type: r for r in acts.collect()}["STRESS_RESTRICTION"]
    assert row.scenario == -0.08 and row.excess_stressed == pytest.approx(-10 - 80)
    assert row.reason == "Underwater in SPY -8.0% stress scenario"


def test_short_exposure_fails_upwards(spark):
    acts = run(spark, [event(1, 0, 0.055, exposure=-1000.0)], True)
    (row,) = acts.collect()
    assert row.event_type == "STRESS_RESTRICTION" and row.scenario == 0.06


def test_no_way_back_up(spark):
    acts = run(spark, [event(1, 0, -0.01), event(2, 5, 0.5), event(3, 6, 0.02), event(4, 40, -0.01)])
    assert [(n, t) for _, _, n, t in taken(acts)] == [(1, "MARGIN_CALL_ISSUED"), (4, "RESTRICTION_APPLIED")]


def random_events(seed, count=400, accounts=12):
    rnd = random.Random(seed)
    out = []
    for n in range(count):
        # account 0 owns a third of all events; equal times are common
        account = "acct0" if rnd.random() < 0.33 else f"acct{rnd.randrange(accounts)}"
        pct = rnd.choice([0.5, 0.2, 0.1, 0.06, 0.04, 0.01, 0.0, -0.01, -0.05, -0.2])
        out.append(event(n, rnd.randrange(0, 180, 5), pct, account, mv=float(rnd.randrange(1, 5) * 1000), exposure=rnd.choice([-2000.0, 0.0, 1000.0, 3000.0])))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("stress", [False, True])
def test_equals_state_machine(spark, seed, stress):
    events = random_events(seed)
    assert taken(run(spark, events, stress)) == walk(events, stress)


@pytest.mark.parametrize("stress", [False, True])
def test_equals_state_machine_salted(spark, no_broadcast, stress):
    events = random_events(9)
    random.Random(0).shuffle(events)
    assert taken(run(spark, events, stress)) == walk(events, stress)


@pytest.mark.parametrize("stress", [False, True])
def test_micro_batches_equal_the_whole(spark, stress):
    events = sorted(random_events(5, 240), key=lambda e: (e[1], e[2]))
    history, got = None, []
    for part in (events[:70], events[70:150], events[150:]):
        acts = run(spark, part, stress, None if history is None else latest_state(history))
        got += taken(acts)
        rows = state_history(acts)
        history = rows if history is None else history.unionByName(rows)
        history = spark.createDataFrame(history.collect(), history.schema)
    assert sorted(got) == walk(events, stress)


def months_of_events(seed, count=500, accounts=8):
    """Random events spread over five months, so that states run out in between."""
    spread = random.Random(seed + 100)
    moved = [(a, ts + timedelta(days=spread.randrange(150)), *rest) for a, ts, *rest in random_events(seed, count, accounts)]
    return sorted(moved, key=lambda e: (e[1], e[2]))


@pytest.mark.parametrize("stress", [False, True])
@pytest.mark.parametrize("cuts", [1, 3, 10])
def test_states_run_out_whatever_the_cut(spark, stress, cuts):
    events = months_of_events(6)
    history, got = None, []
    size = -(-len(events) // cuts)
    for at in range(0, len(events), size):
        acts = run(spark, events[at : at + size], stress, None if history is None else latest_state(history))
        got += taken(acts)
        rows = state_history(acts)
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        history = rows if history is None else spark.createDataFrame(history.unionByName(rows).collect(), rows.schema)
    expected = walk(events, stress)
    assert sorted(got) == expected
    assert len({(a, t) for a, _, _, t in expected}) < len(expected)  # some accounts start anew


def test_state_lives_to_its_last_instant(spark):
    month = 30 * 24 * 60
    events = [event(1, 0, -0.01), event(2, month - 1, -0.01, "b"), event(3, month, -0.01)]
    acts = taken(run(spark, events))
    assert [(n, t) for _, _, n, t in acts] == [(1, "MARGIN_CALL_ISSUED"), (3, "MARGIN_CALL_ISSUED"), (2, "MARGIN_CALL_ISSUED")]
    events[2] = event(3, month - 1, -0.01)
    assert ("a", T0 + timedelta(minutes=month - 1), 3, "RESTRICTION_APPLIED") in taken(run(spark, events))


def test_times_are_ordered(spark):
    acts = run(spark, random_events(4))
    first = acts.groupBy("account_id").pivot("event_type").agg(F.min("ts"))
    assert first.filter("WARNING_ISSUED > MARGIN_CALL_ISSUED or MARGIN_CALL_ISSUED >= RESTRICTION_APPLIED").count() == 0


def test_state_rows(spark):
    acts = run(spark, [event(1, 0, 0.03), event(2, 1, -0.01), event(3, 60, -0.2), event(4, 0, 0.03, "b")])
    history = state_history(acts)
    assert history.count() == 4  # the liquidation writes no state
    now = {r.account_id: (r.status, r.last_action) for r in latest_state(history).collect()}
    assert now == {"a": ("RESTRICTED", "RESTRICTION_APPLIED"), "b": ("WARNING", "WARNING_ISSUED")}
    newest = audit.state_rows_per_account(history, 2)
    assert newest.count() == 3 and newest.agg(F.max("rn")).first()[0] == 2
    later = F.lit(T0 + timedelta(days=30)).cast("timestamp_ntz")
    assert live_state(history, later).count() == 2
    looked_up = with_state(
        spark.createDataFrame([event(9, 99, 0.1, "zzz")], SCHEMA), latest_state(history)
    ).first()
    assert looked_up.status == "ACTIVE"


def test_audit_queries(spark):
    acts = run(spark, [event(1, 0, 0.03), event(2, 1, -0.01), event(3, 60, -0.2), event(4, 0, 0.03, "b")])
    log = audit.audit_events(acts)
    assert log.select("event_id").distinct().count() == log.count() == 5
    assert [tuple(r) for r in audit.counts_by_type(log).collect()][0] == ("WARNING_ISSUED", 2)
    assert [r.account_id for r in audit.accounts_with(log, "LIQUIDATION_TRIGGERED").collect()] == ["a"]
    call = audit.by_account_and_type(log, "a", "MARGIN_CALL_ISSUED").first()
    assert audit.by_correlation(log, call.correlation_id).count() == 1
    after = F.lit(T0 + timedelta(days=90)).cast("timestamp_ntz")
    assert audit.retained(log, after).count() == 3
    (note,) = audit.call_notifications(acts).collect()
    assert "account a" in note.message and "$10.00" in note.message
