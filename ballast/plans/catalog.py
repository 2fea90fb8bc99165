"""Registered batch queries: each takes (spark, root) and returns a frame."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.functions.columns import is_warning, tidy
from ballast.functions.skew import hot_keys
from ballast.operators import addons, asof, audit, firm, history, liquidation, margin, positions, stress
from ballast.operators import ladder as enforcement
from ballast.params import DEFAULT, TOPIC_FILLS
from ballast.params import SCALE as DEFAULT_SCALE
from ballast.plans import fixtures
from ballast.session import work_folder
from ballast.sinks import events as sinks
from ballast.sources import events as wire
from ballast.sources import files, tables


# Amounts per account have at most eight decimals, so at eight places a float
# sum shows its exact value whatever the order of summation.
EXACT = 8


def _rounded(df: DataFrame, *names: str, places: int = EXACT) -> DataFrame:
    return df.withColumns({n: tidy(F.col(n), places) for n in names})


def hot_symbols(spark: SparkSession, root: str) -> DataFrame:
    """Symbols with too many ticks for one task; reads one column."""
    return hot_keys(tables.table(spark, root, "lineitem").select(F.col("l_partkey").alias("symbol")), ["symbol"])


# building blocks -----------------------------------------------------------


def marks(spark, root):
    return positions.marks(tables.last_prices(spark, root), tables.betas(spark, root))


def marks_with_gaps(spark, root):
    """Marks without the price of every 23rd and the beta of every 17th symbol: the fixture of missing marks."""
    return positions.marks(
        fixtures.with_gaps(tables.last_prices(spark, root), 23), fixtures.with_gaps(tables.betas(spark, root), 17)
    )


def valued(spark, root, hot=None):
    held = positions.net_positions(tables.trades(spark, root)).select("account_id", "symbol", "qty")
    return positions.value_positions(held, marks(spark, root), hot=hot)


def margin_flat(spark, root, hot=None):
    return margin.account_margin(valued(spark, root, hot))


def margin_cash(spark, root, **options):
    return margin.account_margin_cash(valued(spark, root), tables.cash(spark, root), **options)


def actions(spark, root, with_stress=False):
    return enforcement.ladder(tables.margin_events(spark, root), stress=with_stress)


def state_rows(spark, root):
    return enforcement.state_history(actions(spark, root, True))


MARGIN_SUMS = ("total_mv", "beta_weighted_exposure", "cash", "equity", "maintenance_req", "excess")


def _margin_report(df):
    return _rounded(_rounded(df.select("account_id", *MARGIN_SUMS, "excess_pct"), *MARGIN_SUMS), "excess_pct", places=6)


# sources -------------------------------------------------------------------


def decode_events(spark, root):
    messages = fixtures.replay_messages(tables.table(spark, root, "events"))
    return wire.usable_rows(messages, TOPIC_FILLS).select(
        F.col("seq").alias("offset"), "account_id", "symbol", "qty", "price", "timestamp", "fill_id"
    )


def route_by_topic(spark, root):
    messages = fixtures.replay_messages(tables.table(spark, root, "events"))
    return (
        wire.routed(messages)
        .groupBy("topic", "route")
        .agg(F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first"), F.max("offset").alias("last"))
    )


def dead_letters(spark, root):
    messages = fixtures.replay_messages(tables.table(spark, root, "events"))
    return wire.dead_letters(messages).select("topic", "key", "offset", "reason")


def backtest_replay(spark, root):
    folder = work_folder(spark, "history")
    tables.prices(spark, root).select(
        F.col("ts").alias("timestamp"), F.col("symbol").cast("string").alias("symbol"), "price"
    ).write.csv(folder, header=True)
    return files.price_history(spark, folder)


def audit_scan_pruned(spark, root):
    folder = work_folder(spark, "audit")
    sinks.write_audit(audit.audit_events(actions(spark, root)), folder)
    log = files.audit_day(files.audit_log(spark, folder, "BIGINT"), 2024, 1, 16)
    return log.groupBy("hour", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("details.deficiency").alias("with_deficiency"),
        F.count_distinct("causation_id").alias("causes"),
    )


def audit_partitions(spark, root):
    return (
        audit.with_hours(audit.audit_events(actions(spark, root, True)))
        .groupBy("year", "month", "day", "hour")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def scenario_table(spark, root):
    return _rounded(firm.scenario_table(margin.account_totals(valued(spark, root))), "total_pnl", places=1)


def account_cash(spark, root):
    profile = tables.accounts(spark, root).select("account_id", "risk_profile")
    return _rounded(tables.cash(spark, root).join(profile, "account_id"), "cash")


# positions and marks -------------------------------------------------------


def net_positions(spark, root):
    return positions.net_positions(tables.trades(spark, root))


def open_positions(spark, root):
    return positions.open_positions(positions.net_positions(tables.trades(spark, root)))


def latest_price(spark, root):
    return tables.last_prices(spark, root)


def latest_price_rn(spark, root):
    return positions.latest_value_ranked(tables.prices(spark, root), "price")


def latest_beta(spark, root):
    """Betas restated over time: each line item restates its symbol's beta by its own tax rate."""
    ticks = tables.table(spark, root, "lineitem").filter("l_partkey IS NOT NULL").selectExpr(
        "l_partkey AS symbol", "0.5D + l_tax * 10 AS beta", "l_shipdate AS ts", tables.SEQ
    )
    return positions.latest_value(ticks, "beta", ("ts", "seq", "beta"))


def positions_valued(spark, root):
    return valued(spark, root)


def positions_valued_nulls(spark, root):
    held = positions.net_positions(tables.trades(spark, root)).select("account_id", "symbol", "qty")
    return positions.value_positions(held, marks_with_gaps(spark, root), "null")


def positions_valued_fill_price(spark, root):
    newest = F.max_by("price", F.struct("ts", "seq", "price")).alias("fill_price")
    held = tables.fills(spark, root).groupBy("account_id", "symbol").agg(F.sum("qty").alias("qty"), newest)
    return positions.value_positions(held, marks_with_gaps(spark, root), "fill_price")


def position_weights(spark, root):
    weighted = positions.position_weights(positions.open_positions(valued(spark, root)))
    return _rounded(
        weighted.select("account_id", "symbol", "market_value", "total_mv", "weight"), "total_mv"
    ).withColumn("weight", tidy(F.col("weight"), 6))


# margin --------------------------------------------------------------------


def account_margin(spark, root):
    return _margin_report(margin_flat(spark, root))


def account_margin_cash(spark, root):
    return _margin_report(margin_cash(spark, root))


def account_margin_gross(spark, root):
    return _margin_report(margin_cash(spark, root, gross=True))


def house_margin(spark, root):
    return _margin_report(margin_cash(spark, root, rate=DEFAULT.house_rate))


def margin_deficiency(spark, root):
    short = margin.with_deficiency(margin_cash(spark, root)).filter(F.col("deficiency").isNotNull())
    return _rounded(short.select("account_id", "excess", "deficiency"), "excess", "deficiency")


def account_standing(spark, root):
    return margin.with_standing(margin_cash(spark, root)).select("account_id", "standing")


def market_leverage(spark, root):
    return margin.market_leverage(margin_flat(spark, root)).select(
        "account_id", tidy(F.col("market_leverage"), 6).alias("market_leverage")
    )


def initial_margin(spark, root):
    return _rounded(margin.initial_margin(tables.fills(spark, root)), "purchases", "initial_margin")


def leverage_overlay(spark, root):
    out = addons.leverage_overlay(margin_cash(spark, root)).select(
        "account_id", "total_mv", "leverage", "leverage_addon"
    )
    return _rounded(_rounded(out, "total_mv", "leverage_addon"), "leverage", places=6)


def concentration_margin(spark, root):
    return _rounded(
        addons.concentration_margin(valued(spark, root)), "total_mv", "concentration_addon", "maintenance_req"
    )


def volatility_margin(spark, root):
    recent = history.latest_volatility(tables.prices(spark, root))
    return _rounded(
        addons.volatility_margin(valued(spark, root), recent), "total_mv", "volatility_addon", "maintenance_req"
    )


def low_price_margin(spark, root):
    return _rounded(addons.low_price_margin(valued(spark, root)), "total_mv", "maintenance_req")


# stress and grid -----------------------------------------------------------


STRESS_SUMS = ("delta_pnl", "equity_stressed", "excess_stressed")


def _stress_report(df):
    return _rounded(
        df.select("account_id", "scenario", "scenario_type", *STRESS_SUMS, "underwater"), *STRESS_SUMS
    )


def beta_stress(spark, root):
    return _stress_report(stress.beta_stress(margin_flat(spark, root)))


def beta_stress_cash(spark, root):
    return _stress_report(stress.beta_stress(margin_cash(spark, root)))


def severe_underwater(spark, root):
    return _stress_report(stress.severe_underwater(stress.beta_stress(margin_cash(spark, root))))


def grid_pnl(spark, root):
    return _rounded(stress.grid_pnl(margin.account_totals(valued(spark, root))), "portfolio_pnl")


def grid_pnl_by_position(spark, root):
    return _rounded(stress.grid_pnl_by_position(valued(spark, root)), "portfolio_pnl")


def portfolio_margin(spark, root):
    worst = stress.worst_case(margin.account_totals(valued(spark, root)))
    return _rounded(
        worst.select("account_id", "worst_case_loss", "worst_scenario", "portfolio_margin_req"),
        "worst_case_loss",
        "portfolio_margin_req",
    )


def margin_comparison(spark, root):
    totals = margin.account_totals(valued(spark, root))
    return _rounded(
        stress.compare_methods(totals, stress.worst_case(totals)),
        "total_mv",
        "reg_t_margin",
        "portfolio_margin_req",
        "margin_savings",
    )


def all_scenarios(spark, root):
    account = margin_flat(spark, root)
    both = stress.all_scenarios(stress.beta_stress(account), stress.grid_pnl(account))
    return _rounded(both, "delta_pnl", "excess_stressed", "portfolio_pnl")


def firm_risk(spark, root):
    return _rounded(firm.firm_risk(margin_flat(spark, root)), "firm_beta_weighted_exposure", "firm_total_mv", places=1)


def firm_stress(spark, root):
    out = firm.firm_stress(firm.firm_risk(margin_flat(spark, root))).select(
        "scenario", "num_accounts", "firm_delta_pnl", "limit_breached"
    )
    return _rounded(out, "firm_delta_pnl", places=1)


def firm_limit_alert(spark, root):
    out = firm.firm_limit_alert(firm.firm_risk(margin_flat(spark, root)))
    return _rounded(out, "firm_beta_weighted_exposure", "firm_total_mv", places=1)


def margin_distribution(spark, root):
    return _rounded(firm.margin_distribution(margin_cash(spark, root)), "total_mv", places=5)


def stress_pass_rate(spark, root):
    return _rounded(
        firm.stress_pass_rate(stress.beta_stress(margin_cash(spark, root))), "fail_rate", places=6
    )


# price history -------------------------------------------------------------


def price_returns(spark, root):
    ticks = history.price_returns(tables.prices(spark, root), hot=hot_symbols(spark, root))
    return ticks.select("symbol", "ts", "seq.l_orderkey", "seq.l_linenumber", "price", "return")


def rolling_volatility(spark, root):
    ticks = history.rolling_volatility(tables.prices(spark, root), hot=hot_symbols(spark, root))
    return ticks.select(
        "symbol",
        "ts",
        "seq.l_orderkey",
        "seq.l_linenumber",
        tidy(F.col("volatility"), 6).alias("volatility"),
        tidy(F.col("volatility_annual"), 6).alias("volatility_annual"),
    )


def latest_volatility(spark, root):
    return history.latest_volatility(tables.prices(spark, root)).select(
        "symbol", tidy(F.col("volatility_annual"), 6).alias("volatility_annual")
    )


def estimated_beta(spark, root):
    """Beta of each symbol from the returns between the closing prices of the days on which it traded."""
    closes = history.daily_closes(tables.prices(spark, root))
    # a symbol has a row a day, so none is hot by days
    returns = history.price_returns(closes, order=["ts"]).filter("return IS NOT NULL")
    betas = history.estimated_beta(returns.select("symbol", F.col("ts").alias("day"), "return"))
    return betas.withColumn("estimated_beta", tidy(F.col("estimated_beta"), 4))


def shocked_prices(spark, root):
    priced = marks(spark, root).filter(F.col("price").isNotNull()).fillna({"beta": DEFAULT.default_beta})
    return history.shocked_prices(priced).select(
        "symbol", "step", "market_move", "shocked_price"
    )


def asof_fill_price(spark, root):
    return asof.as_of(
        tables.fills(spark, root), tables.prices(spark, root), "price", "mark", hot=hot_symbols(spark, root)
    ).select(
        "account_id", "symbol", "ts", "seq.l_orderkey", "seq.l_linenumber", "qty", "price", "mark"
    )


def asof_prior_price(spark, root):
    return asof.as_of(
        tables.fills(spark, root),
        tables.prices(spark, root),
        "price",
        "prior_mark",
        strict=True,
        hot=hot_symbols(spark, root),
    ).select("account_id", "symbol", "ts", "seq.l_orderkey", "seq.l_linenumber", "qty", "price", "prior_mark")


# enforcement ---------------------------------------------------------------

ACTION_COLUMNS = (
    "account_id",
    "ts",
    "event_id",
    "event_type",
    "status",
    "deficiency",
    "excess",
    "scenario",
    "excess_stressed",
    "margin_call_issued_at",
)


def ladder_margin(spark, root):
    return _rounded(actions(spark, root).select(*ACTION_COLUMNS), "deficiency", "excess", "excess_stressed")


def ladder_combined(spark, root):
    return _rounded(
        actions(spark, root, True).select(*ACTION_COLUMNS), "deficiency", "excess", "excess_stressed", places=4
    )


def ladder_expiry(spark, root):
    taken = enforcement.ladder(fixtures.spread_out(tables.margin_events(spark, root)), stress=True)
    return _rounded(taken.select(*ACTION_COLUMNS), "deficiency", "excess", "excess_stressed")


def warning_candidates(spark, root):
    events = tables.margin_events(spark, root)
    return _rounded(
        events.filter(is_warning(F.col("excess"), F.col("total_mv"))).select(
            "event_id", "account_id", "ts", "total_mv", "excess"
        ),
        "excess",
    )


def control_events(spark, root):
    rows = audit.control_events(actions(spark, root)).unionByName(audit.control_events(actions(spark, root, True)))
    return _rounded(
        rows, "deficiency", "excess", "equity", "maintenance_req", "excess_stressed", places=4
    )


def audit_events(spark, root):
    rows = audit.audit_events(actions(spark, root, True)).select(
        "event_id", "event_type", "account_id", "timestamp", "details.*", "correlation_id", "causation_id"
    )
    amounts = ("deficiency", "excess", "equity", "maintenance_req", "excess_stressed")
    return _rounded(_rounded(rows, *amounts), "excess_pct", "elapsed_minutes", places=6)


def audit_by_account(spark, root):
    calls = audit.audit_events(actions(spark, root)).filter(F.col("event_type") == "MARGIN_CALL_ISSUED")
    out = calls.select("account_id", "timestamp", "event_id", F.col("details.deficiency").alias("deficiency"))
    return _rounded(out, "deficiency").orderBy("account_id", F.desc("timestamp"))


def audit_counts(spark, root):
    return audit.counts_by_type(audit.audit_events(actions(spark, root)))


def liquidated_accounts(spark, root):
    return audit.accounts_with(audit.audit_events(actions(spark, root)), "LIQUIDATION_TRIGGERED")


def action_counts(spark, root):
    return (
        actions(spark, root, True)
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "topic", "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def backtest_summary(spark, root):
    kinds = actions(spark, root).withColumn("variant", F.lit("margin")).unionByName(
        actions(spark, root, True).withColumn("variant", F.lit("combined"))
    )
    return kinds.groupBy("variant", "event_type", "scenario").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("account_id").alias("accounts")
    )


def call_notifications(spark, root):
    return audit.call_notifications(actions(spark, root))


def account_state_latest(spark, root):
    return _rounded(
        enforcement.latest_state(state_rows(spark, root)),
        "equity",
        "excess",
        "excess_stressed",
    )


def account_state_history(spark, root):
    return _rounded(
        audit.state_rows_per_account(state_rows(spark, root)).select(
            "account_id", "rn", "ts", "status", "last_action", "excess", "ttl"
        ),
        "excess",
    )


def owner_state_history(spark, root):
    """The newest ten state rows over all accounts of an owner, who has one for each day of the month."""
    owned = state_rows(spark, root).withColumn("own", F.col("account_id")).withColumn("account_id", F.expr("account_id DIV 100"))
    newest = audit.state_rows_per_account(owned)
    return newest.select(F.col("account_id").alias("owner"), "rn", "ts", F.col("own").alias("account_id"), "status", "last_action")


def account_state_live(spark, root):
    now = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    return enforcement.live_state(state_rows(spark, root), now).select(
        "account_id", "ts", "status", "last_action", "ttl"
    )


def state_lookup(spark, root):
    events = tables.margin_events(spark, root)
    latest = enforcement.latest_state(state_rows(spark, root))
    return enforcement.with_state(events, latest).select(
        "event_id", "account_id", "ts", "status", "margin_call_issued_at", "last_action"
    )


def in_month(rows: DataFrame) -> DataFrame:
    """Fixture: fills and ticks dealt over the days of the calls' month, so that some come before a call and some after."""
    return rows.withColumn(
        "ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(CAST(pmod(datediff(ts, date'1992-01-01'), 30) AS INT))")
    )


def trace_call(spark, root):
    traced = audit.trace_call(
        actions(spark, root),
        tables.margin_events(spark, root),
        in_month(tables.prices(spark, root)),
        in_month(tables.trades(spark, root)),
        hot=hot_symbols(spark, root),
    )
    return _rounded(
        traced.select(
            "account_id",
            "ts",
            "correlation_id",
            "margin_event_id",
            "margin_mv",
            "deficiency",
            F.col("symbol").cast("string").alias("symbol"),
            "fill_ts",
            "opening_fill_ts",
            "price_in_force",
        ),
        "deficiency",
    )


def e2e_latency(spark, root):
    return audit.end_to_end_latency(actions(spark, root), in_month(tables.trades(spark, root))).select(
        "account_id", "ts", "fill_ts", "latency_seconds"
    )


def liquidation_selection(spark, root):
    book = valued(spark, root)
    chosen = liquidation.liquidation_selection(book, margin_cash(spark, root))
    return _rounded(
        chosen.drop("lines_before"), "proceeds_before", "deficiency", "target"
    )


def _orders(spark, root):
    chosen = liquidation.liquidation_selection(valued(spark, root), margin_cash(spark, root))
    return liquidation.liquidation_orders(chosen, at=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


def liquidation_orders(spark, root):
    return _orders(spark, root).withColumn("deficiency", tidy(F.col("deficiency"), EXACT))


def liquidation_order_lines(spark, root):
    """The orders line by line, numbered within the account."""
    lines = _orders(spark, root).select(
        "account_id", "page", "pages", "reason", "deficiency", "timestamp", F.posexplode("positions").alias("pos", "line")
    )
    number = F.col("page").cast("bigint") * DEFAULT_SCALE.page_rows + F.col("pos")
    out = lines.select("account_id", number.alias("line_no"), "pages", "reason", "deficiency", "timestamp", "line.*")
    return _rounded(out, "deficiency")


def audit_by_correlation(spark, root):
    """Everything that was recorded under the correlation id of each margin call, in order of time."""
    trail = audit.audit_events(actions(spark, root))
    calls = trail.filter(F.col("event_type") == "MARGIN_CALL_ISSUED").select("correlation_id")
    out = trail.join(calls, "correlation_id", "left_semi")
    return out.select("correlation_id", "timestamp", "event_type", "event_id", "account_id")


def audit_retained(spark, root):
    """Audit rows still kept in the middle of April: the first half of January is past its 90 days, and its folders go."""
    folder = work_folder(spark, "audit")
    sinks.write_audit(audit.audit_events(actions(spark, root, True)), folder)
    oldest = datetime(2024, 4, 15) - timedelta(days=DEFAULT.audit_retention_days)
    files.drop_expired(spark, folder, oldest)
    kept = files.audit_since(files.audit_log(spark, folder, "BIGINT"), oldest)
    return kept.select("event_id", "timestamp", "event_type", "account_id")


def event_display_line(spark, root):
    """Events of all kinds as lines of text."""
    hot = hot_symbols(spark, root)
    fills, ticks, betas = tables.fills(spark, root, hot), tables.prices(spark, root, hot), tables.betas(spark, root)
    snapshots, acts = tables.margin_events(spark, root), actions(spark, root, True)
    stressed = stress.beta_stress(margin_flat(spark, root, hot)).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    betas = betas.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    trail = audit.audit_events(acts).withColumn("ts", F.col("timestamp"))
    lines = [
        df.select("ts", sinks.display_line(kind, df).alias("display_line"))
        for kind, df in (
            ("fill", fills), ("price", ticks), ("beta", betas), ("margin", snapshots), ("stress", stressed), ("audit", trail)
        )
    ]
    return reduce(DataFrame.unionByName, lines, sinks.display_actions(acts).select("ts", "display_line"))


def dedup_fills(spark, root):
    """Each fill once, though every third order is delivered twice: repeats agree in every column as delivered."""
    lines = tables.table(spark, root, "lineitem")
    times = F.when(F.col("l_orderkey") % 3 == 0, 2).otherwise(1)
    delivered = lines.withColumn("delivery", F.explode(F.sequence(F.lit(1), times))).drop("delivery")
    return delivered.dropDuplicates().select(
        fixtures.fill_id().alias("fill_id"), F.col("l_partkey").alias("symbol"), F.expr(tables.SIGNED_QTY), F.col("l_shipdate").alias("ts")
    )


BATCH = {
    f.__name__: f
    for f in (
        decode_events,
        route_by_topic,
        dead_letters,
        dedup_fills,
        backtest_replay,
        audit_scan_pruned,
        audit_partitions,
        scenario_table,
        account_cash,
        net_positions,
        open_positions,
        latest_price,
        latest_price_rn,
        latest_beta,
        positions_valued,
        positions_valued_nulls,
        positions_valued_fill_price,
        position_weights,
        account_margin,
        account_margin_cash,
        account_margin_gross,
        house_margin,
        margin_deficiency,
        account_standing,
        market_leverage,
        initial_margin,
        leverage_overlay,
        concentration_margin,
        volatility_margin,
        low_price_margin,
        beta_stress,
        beta_stress_cash,
        severe_underwater,
        grid_pnl,
        grid_pnl_by_position,
        portfolio_margin,
        margin_comparison,
        all_scenarios,
        firm_risk,
        firm_stress,
        firm_limit_alert,
        margin_distribution,
        stress_pass_rate,
        price_returns,
        rolling_volatility,
        latest_volatility,
        estimated_beta,
        shocked_prices,
        asof_fill_price,
        asof_prior_price,
        ladder_margin,
        ladder_combined,
        ladder_expiry,
        warning_candidates,
        control_events,
        audit_events,
        audit_by_account,
        audit_by_correlation,
        audit_retained,
        audit_counts,
        liquidated_accounts,
        action_counts,
        backtest_summary,
        call_notifications,
        account_state_latest,
        account_state_history,
        owner_state_history,
        account_state_live,
        state_lookup,
        trace_call,
        e2e_latency,
        liquidation_selection,
        liquidation_orders,
        liquidation_order_lines,
        event_display_line,
    )
}
