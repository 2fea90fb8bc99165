"""Worked examples with known answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ballast.operators import addons, firm, history, liquidation, margin, positions, stress
from ballast.params import RiskParams, Scale

DEMO_PRICES = [400.0, 392.0, 384.0, 368.0, 352.0, 336.0]


def book(spark, holdings, marks):
    """holdings: (account, symbol, qty); marks: symbol -> (price, beta), either may be None."""
    held = spark.createDataFrame(holdings, "account_id STRING, symbol STRING, qty BIGINT")
    quotes = spark.createDataFrame(
        [(s, p, b) for s, (p, b) in marks.items()], "symbol STRING, price DOUBLE, beta DOUBLE"
    )
    return positions.value_positions(held, quotes)


def cash_of(spark, **balances):
    return spark.createDataFrame([(k, float(v)) for k, v in balances.items()], "account_id STRING, cash DOUBLE")


def one(df):
    (row,) = df.collect()
    return row


@pytest.mark.parametrize(
    "price,excess,stressed",
    list(
        zip(
            DEMO_PRICES,
            [200_000, 197_000, 194_000, 188_000, 182_000, 176_000],
            [171_200, 168_776, 166_352, 161_504, 156_656, 151_808],
        )
    ),
)
def test_demo_account(spark, price, excess, stressed):
    valued = book(spark, [("demo", "NVDA", 500)], {"NVDA": (price, 1.8), "SPY": (450.0, 1.0)})
    account = margin.account_margin_cash(valued, cash_of(spark, demo=50_000))
    row = one(account)
    assert row.total_mv == pytest.approx(500 * price)
    assert row.equity == pytest.approx(50_000 + 500 * price)
    assert row.maintenance_req == pytest.approx(125 * price)
    assert row.excess == pytest.approx(excess)
    assert row.beta_weighted_exposure == pytest.approx(900 * price)
    worst = {r.scenario: r for r in stress.beta_stress(account).collect()}
    assert worst[-0.08].excess_stressed == pytest.approx(stressed)
    assert worst[0.0].excess_stressed == pytest.approx(excess)
    assert len(worst) == 8 and not any(r.underwater for r in worst.values())


@pytest.mark.parametrize(
    "price,excess,stressed",
    [(400.0, 340_000, 282_400), (364.0, 313_000, 260_584), (344.36, 298_270, 248_682.16), (292.0, 259_000, 216_952)],
)
def test_concentrated_account(spark, price, excess, stressed):
    valued = book(spark, [("a", "NVDA", 1000)], {"NVDA": (price, 1.8)})
    account = margin.account_margin_cash(valued, cash_of(spark, a=40_000))
    assert one(account).excess == pytest.approx(excess)
    row = one(stress.beta_stress(account).filter("scenario = -0.08"))
    assert row.excess_stressed == pytest.approx(stressed)


THREE = [("a", "AAPL", 100), ("a", "NVDA", 50), ("a", "KO", 200)]
THREE_MARKS = {"AAPL": (150.0, 1.2), "NVDA": (400.0, 1.8), "KO": (60.0, 0.6)}


def test_three_positions(spark):
    account = margin.account_margin_cash(book(spark, THREE, THREE_MARKS), cash_of(spark, a=10_000))
    row = one(margin.market_leverage(account))
    assert (row.total_mv, row.equity, row.excess) == pytest.approx((47_000, 57_000, 45_250))
    assert row.beta_weighted_exposure == pytest.approx(61_200)
    assert row.market_leverage == pytest.approx(61_200 / 47_000)
    by_move = {r.scenario: r.excess_stressed for r in stress.beta_stress(account).collect()}
    assert by_move[-0.08] == pytest.approx(40_354)
    assert by_move[-0.06] == pytest.approx(41_578)


def test_high_beta_account_with_wider_scenarios(spark):
    totals = spark.createDataFrame(
        [("a", 95_000.0, 140_000.0, 5_000.0)],
        "account_id STRING, total_mv DOUBLE, beta_weighted_exposure DOUBLE, cash DOUBLE",
    )
    account = margin.margin_columns(totals)
    params = RiskParams(index_scenarios=(-0.08, -0.10, -0.15))
    got = {r.scenario: r.excess_stressed for r in stress.beta_stress(account, params).collect()}
    assert one(account).excess == pytest.approx(76_250)
    assert got == pytest.approx({-0.08: 65_050, -0.10: 62_250, -0.15: 55_250})


def test_hedged_book_needs_no_portfolio_margin(spark):
    valued = book(spark, [("a", "X", 100), ("a", "Y", -50)], {"X": (150.0, 1.0), "Y": (300.0, 1.0)})
    totals = margin.account_totals(valued)
    assert all(r.portfolio_pnl == 0 for r in stress.grid_pnl(totals).collect())
    assert one(stress.worst_case(totals)).portfolio_margin_req == 0
    both = one(stress.compare_methods(totals, stress.worst_case(totals)))
    assert both.margin_method == "REG_T" and both.margin_savings == 0


def test_partly_hedged_book_saves_margin(spark):
    valued = book(
        spark,
        [("hedged", "X", 100), ("hedged", "Y", -40), ("long", "X", 100)],
        {"X": (150.0, 1.0), "Y": (300.0, 1.0)},
    )
    totals = margin.account_totals(valued)
    got = {r.account_id: r for r in stress.compare_methods(totals, stress.worst_case(totals)).collect()}
    assert got["hedged"].portfolio_margin_req == pytest.approx(450)
    assert got["hedged"].margin_method == "PORTFOLIO" and got["hedged"].margin_savings == pytest.approx(300)
    assert got["long"].portfolio_margin_req == pytest.approx(2_250)


def test_both_grid_forms_agree(spark):
    valued = book(spark, THREE + [("b", "KO", -7)], THREE_MARKS)
    fast = {(r.account_id, r.scenario): r.portfolio_pnl for r in stress.grid_pnl(margin.account_totals(valued)).collect()}
    slow = {(r.account_id, r.scenario): r.portfolio_pnl for r in stress.grid_pnl_by_position(valued).collect()}
    assert fast == pytest.approx(slow) and len(fast) == 20
    worst = stress.worst_of_grid(stress.grid_pnl_by_position(valued))
    direct = stress.worst_case(margin.account_totals(valued)).select(*worst.columns)
    for a, b in zip(worst.orderBy("account_id").collect(), direct.orderBy("account_id").collect()):
        assert tuple(a)[1:] == pytest.approx(tuple(b)[1:])


def test_cash_as_share_of_value(spark):
    row = one(margin.account_margin(book(spark, THREE, THREE_MARKS)))
    assert row.equity == pytest.approx(1.1 * 47_000)
    assert row.excess == pytest.approx(0.85 * 47_000)
    assert row.excess_pct == pytest.approx(0.85)


def test_flat_position(spark):
    fills = spark.createDataFrame(
        [("a", "X", 10, "2024-01-01"), ("a", "X", -10, "2024-01-02")], "account_id STRING, symbol STRING, qty INT, ts STRING"
    ).withColumn("ts", F.to_timestamp_ntz("ts"))
    held = positions.net_positions(fills)
    assert one(held).qty == 0
    assert positions.open_positions(held).count() == 0
    valued = book(spark, [("a", "X", 0)], {"X": (5.0, 1.0)})
    row = one(margin.account_margin(valued))
    assert row.total_mv == 0 and row.excess_pct is None


def test_missing_marks(spark):
    held = spark.createDataFrame([("a", "X", 3, 7.0), ("a", "Y", 2, 5.0)], "account_id STRING, symbol STRING, qty INT, fill_price DOUBLE")
    quotes = spark.createDataFrame([("X", 10.0, None)], "symbol STRING, price DOUBLE, beta DOUBLE")
    by = lambda mode: {r.symbol: (r.price, r.beta, r.market_value) for r in positions.value_positions(held, quotes, mode).collect()}
    assert by("zero") == {"X": (10.0, 1.0, 30.0), "Y": (0.0, 1.0, 0.0)}
    assert by("null") == {"X": (10.0, None, 30.0), "Y": (None, None, None)}
    assert by("fill_price") == {"X": (10.0, 1.0, 30.0), "Y": (5.0, 1.0, 10.0)}
    with pytest.raises(KeyError):
        by("guess")


def test_profiles_with_shorts(spark):
    marks = {"AAPL": (175.0, 1.2), "MSFT": (380.0, 1.1), "GOOGL": (140.0, 1.15), "AMZN": (155.0, 1.3)}
    hedged = [("h", "AAPL", 500), ("h", "MSFT", -200), ("h", "GOOGL", 300), ("h", "AMZN", -100)]
    row = one(margin.account_margin_cash(book(spark, hedged, marks), cash_of(spark, h=300_000)))
    assert row.total_mv == pytest.approx(87_500 - 76_000 + 42_000 - 15_500)
    assert row.excess == pytest.approx(300_000 + 0.75 * 38_000)


def test_net_short_requirement(spark):
    valued = book(spark, [("s", "X", -100)], {"X": (10.0, 1.0)})
    balances = cash_of(spark, s=1_500)
    assert one(margin.account_margin_cash(valued, balances)).maintenance_req == pytest.approx(-250)
    gross = one(margin.account_margin_cash(valued, balances, gross=True))
    assert gross.maintenance_req == pytest.approx(250) and gross.excess == pytest.approx(250)


def test_standing_and_deficiency(spark):
    rows = spark.createDataFrame(
        [("a", -1.0, 100.0), ("b", 4.99, 100.0), ("c", 5.0, 100.0)], "account_id STRING, excess DOUBLE, total_mv DOUBLE"
    )
    got = {r.account_id: (r.standing, r.deficiency) for r in margin.with_deficiency(margin.with_standing(rows)).collect()}
    assert got == {"a": ("DEFICIENT", 1.0), "b": ("WARNING", None), "c": ("GOOD", None)}


def test_concentration(spark):
    valued = book(spark, [("a", "X", 80), ("a", "Y", 20)], {"X": (10.0, 1.0), "Y": (10.0, 1.0)})
    row = one(addons.concentration_margin(valued))
    assert row.concentration_addon == pytest.approx(80)
    assert row.maintenance_req == pytest.approx(330)


def test_volatility_tiers(spark):
    valued = book(spark, [("a", s, 10) for s in "WXYZ"], {s: (10.0, 1.0) for s in "WXYZ"})
    vol = spark.createDataFrame([("W", 0.61), ("X", 0.60), ("Y", 0.40)], "symbol STRING, volatility_annual DOUBLE")
    row = one(addons.volatility_margin(valued, vol))
    assert row.volatility_addon == pytest.approx(10 + 5)


def test_low_price_and_leverage(spark):
    valued = book(spark, [("a", "X", 10), ("a", "Y", 10)], {"X": (4.99, 1.0), "Y": (5.0, 1.0)})
    row = one(addons.low_price_margin(valued))
    assert row.maintenance_req == pytest.approx(49.9 + 12.5) and row.low_priced == 1
    margins = spark.createDataFrame(
        [("a", 201.0, 100.0, 50.0), ("b", 200.0, 100.0, 50.0), ("c", 1.0, 0.0, 50.0)],
        "account_id STRING, beta_weighted_exposure DOUBLE, equity DOUBLE, total_mv DOUBLE",
    )
    got = {r.account_id: r.leverage_addon for r in addons.leverage_overlay(margins).collect()}
    assert got == pytest.approx({"a": 2.5, "b": 0.0, "c": 0.0})


def test_initial_margin(spark):
    fills = spark.createDataFrame([("a", 100, 1000.0), ("a", -5, 10.0)], "account_id STRING, qty INT, price DOUBLE")
    assert one(margin.initial_margin(fills)).initial_margin == pytest.approx(50_000)


def test_firm(spark):
    accounts = spark.createDataFrame(
        [("a", 6e6, 5e6), ("b", 5e6, 4e6)], "account_id STRING, beta_weighted_exposure DOUBLE, total_mv DOUBLE"
    )
    total = firm.firm_risk(accounts)
    assert tuple(one(total)) == (11e6, 9e6, 2)
    assert firm.firm_limit_alert(total).count() == 1
    assert firm.firm_limit_alert(firm.firm_risk(accounts.filter("account_id = 'a'"))).count() == 0
    moves = {r.scenario: r.firm_delta_pnl for r in firm.firm_stress(total).collect()}
    assert moves[-0.08] == pytest.approx(-880_000)


def test_liquidation_takes_highest_beta_first(spark):
    valued = book(
        spark,
        [("a", "HI", 10), ("a", "MID", 10), ("a", "LO", 10), ("a", "SHORT", -50), ("ok", "HI", 5)],
        {"HI": (10.0, 2.0), "MID": (10.0, 1.5), "LO": (10.0, 0.5), "SHORT": (10.0, 3.0)},
    )
    margins = spark.createDataFrame(
        [("a", -100.0, 4), ("ok", 5.0, 1)], "account_id STRING, excess DOUBLE, positions BIGINT"
    )
    chosen = liquidation.liquidation_selection(valued, margins)
    # 110 are owed: 100 from HI do not cover it, 200 with MID do
    assert [r.symbol for r in chosen.orderBy("lines_before").collect()] == ["HI", "MID"]
    order = one(liquidation.liquidation_orders(chosen))
    assert [(p.symbol, p.qty, p.estimated_proceeds) for p in order.positions] == [("HI", 10, 100.0), ("MID", 10, 100.0)]
    assert order.reason == "MARGIN_DEFICIENCY" and order.deficiency == pytest.approx(100)
    pages = liquidation.liquidation_orders(chosen, Scale(page_rows=1)).orderBy("page").collect()
    assert [(p.page, len(p.positions)) for p in pages] == [(0, 1), (1, 1)]


def test_returns_and_volatility(spark):
    ticks = spark.createDataFrame(
        [("X", p, f"2024-01-{d:02d}", d) for d, p in enumerate([100.0, 110.0, 99.0, 0.0, 5.0], 1)],
        "symbol STRING, price DOUBLE, day STRING, seq BIGINT",
    ).select("symbol", "price", F.to_timestamp_ntz("day").alias("ts"), "seq")
    got = [r["return"] for r in history.price_returns(ticks).orderBy("ts").collect()]
    assert got[0] is None and got[4] is None  # no earlier price; earlier price 0
    assert got[1:4] == pytest.approx([0.1, -0.1, -1.0])
    vols = history.rolling_volatility(ticks).orderBy("ts").collect()
    assert vols[2].volatility == pytest.approx(0.02**0.5)
    assert vols[2].volatility_annual == pytest.approx(0.02**0.5 * 252**0.5)


def test_beta_of_a_market_follower(spark):
    # three symbols: the market is their mean; X moves twice as much as Y and Z together suggest
    days, rows = range(1, 9), []
    for d in days:
        m = 0.01 * ((d * 7) % 5 - 2)
        rows += [("X", d, 2.0 * m), ("Y", d, 0.5 * m), ("Z", d, 0.5 * m)]
    got = history.estimated_beta(spark.createDataFrame(rows, "symbol STRING, day INT, return DOUBLE"))
    assert {r.symbol: r.estimated_beta for r in got.collect()} == pytest.approx({"X": 2.0, "Y": 0.5, "Z": 0.5})


def test_shock_path(spark):
    mark = spark.createDataFrame([("X", 100.0, 2.0)], "symbol STRING, price DOUBLE, beta DOUBLE")
    got = [r.shocked_price for r in history.shocked_prices(mark).orderBy("step").collect()]
    assert got[:3] == pytest.approx([100.0, 102.0, 102.0 * 0.99])
    assert len(got) == 6
