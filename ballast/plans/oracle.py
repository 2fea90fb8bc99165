"""The registered queries in plain SQL, written apart from the operators.

Each statement is self-contained and runs over the driver's tables. Sums are
rounded as in the catalog.
"""

from __future__ import annotations

CTE: dict[str, str] = {
    # fills and ticks on the days of the month in which the calls lie
    "in_month": """
        SELECT * REPLACE (TIMESTAMP '2024-01-01'
            + to_days(CAST((date_diff('day', DATE '1992-01-01', CAST(ts AS DATE)) % 30 + 30) % 30 AS INTEGER)) AS ts)
        FROM fills""",
    "fills": """
        SELECT o.o_custkey AS account_id, l.l_partkey AS symbol,
               CAST(l.l_quantity AS INTEGER) * (CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END) AS qty,
               p.p_retailprice * (1 + (l.l_tax - l.l_discount) * 0.25 * (1 + l.l_partkey % 4)) AS price,
               l.l_shipdate AS ts, l.l_orderkey, l.l_linenumber, l.l_suppkey, p.p_retailprice
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey""",
    "prices": "SELECT * FROM fills",
    "betas": """
        SELECT p_partkey AS symbol, 0.5 + CAST(p_size % 16 AS DOUBLE) / 10 AS beta FROM part""",
    "cash": """
        SELECT c.c_custkey AS account_id,
               c.c_acctbal - CAST(60 + 2 * (c.c_custkey % 10) AS DOUBLE) / 100
                   * GREATEST(COALESCE(f.cost, 0.0), 0.0) AS cash
        FROM customer c
        LEFT JOIN (SELECT account_id, SUM(qty * price) AS cost FROM fills GROUP BY account_id) f
               ON f.account_id = c.c_custkey""",
    "margin_events": """
        SELECT event_id, CAST(user_id * 100 + EXTRACT(DAY FROM ts) AS BIGINT) AS account_id, ts,
               CAST(1000 * (1 + event_id % 7) AS DOUBLE) AS total_mv,
               CAST(1000 * (1 + event_id % 7) AS DOUBLE) * (0.25 + (value - 15) / 100) AS equity,
               CAST(250 * (1 + event_id % 7) AS DOUBLE) AS maintenance_req,
               CAST(1000 * (1 + event_id % 7) AS DOUBLE) * ((value - 15) / 100) AS excess,
               CAST(1000 * (1 + event_id % 7) AS DOUBLE) * (0.5 + CAST(event_id % 16 AS DOUBLE) / 10)
                   AS beta_weighted_exposure
        FROM events""",
    "positions": """
        SELECT account_id, symbol, CAST(SUM(qty) AS BIGINT) AS qty, MAX(ts) AS last_updated
        FROM fills GROUP BY account_id, symbol""",
    "last_price": """
        SELECT symbol, price, ts FROM (
            SELECT symbol, price, ts, ROW_NUMBER() OVER (
                PARTITION BY symbol ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, price DESC) AS rn
            FROM prices) WHERE rn = 1""",
    "gap_prices": "SELECT * FROM last_price WHERE symbol % 23 <> 0",
    "gap_betas": "SELECT * FROM betas WHERE symbol % 17 <> 0",
    "valued": """
        SELECT p.account_id, p.symbol, p.qty, COALESCE(pr.price, 0.0) AS price, COALESCE(b.beta, 1.0) AS beta,
               p.qty * COALESCE(pr.price, 0.0) AS market_value,
               p.qty * COALESCE(pr.price, 0.0) * COALESCE(b.beta, 1.0) AS beta_weighted_value
        FROM positions p LEFT JOIN last_price pr ON pr.symbol = p.symbol LEFT JOIN betas b ON b.symbol = p.symbol""",
    "totals": """
        SELECT account_id, SUM(market_value) AS total_mv, SUM(beta_weighted_value) AS beta_weighted_exposure
        FROM valued GROUP BY account_id""",
    "margin_flat": """
        SELECT *, cash + total_mv AS equity, total_mv * 0.25 AS maintenance_req,
               cash + total_mv - total_mv * 0.25 AS excess,
               (cash + total_mv - total_mv * 0.25) / NULLIF(total_mv, 0) AS excess_pct
        FROM (SELECT *, total_mv * 0.1 AS cash FROM totals)""",
    "margin_cash": """
        SELECT *, cash + total_mv AS equity, total_mv * 0.25 AS maintenance_req,
               cash + total_mv - total_mv * 0.25 AS excess,
               (cash + total_mv - total_mv * 0.25) / NULLIF(total_mv, 0) AS excess_pct
        FROM (SELECT t.*, COALESCE(c.cash, 0.0) AS cash
              FROM totals t LEFT JOIN cash c ON c.account_id = t.account_id)""",
    "index_moves": "SELECT unnest(CAST([-0.08, -0.06, -0.04, -0.02, 0.0, 0.02, 0.04, 0.06] AS DOUBLE[])) AS scenario",
    "grid_moves": (
        "SELECT unnest(CAST([-0.15, -0.10, -0.05, -0.03, -0.01, 0.01, 0.03, 0.05, 0.10, 0.15] AS DOUBLE[])) AS scenario"
    ),
    "stress_flat": """
        SELECT m.account_id, s.scenario, 'SPY_BETA_WEIGHTED' AS scenario_type,
               m.beta_weighted_exposure * s.scenario AS delta_pnl,
               m.equity + m.beta_weighted_exposure * s.scenario AS equity_stressed,
               m.equity + m.beta_weighted_exposure * s.scenario - m.maintenance_req AS excess_stressed
        FROM margin_flat m, index_moves s""",
    "stress_cash": """
        SELECT m.account_id, s.scenario, 'SPY_BETA_WEIGHTED' AS scenario_type,
               m.beta_weighted_exposure * s.scenario AS delta_pnl,
               m.equity + m.beta_weighted_exposure * s.scenario AS equity_stressed,
               m.equity + m.beta_weighted_exposure * s.scenario - m.maintenance_req AS excess_stressed
        FROM margin_cash m, index_moves s""",
    "grid": """
        SELECT v.account_id, g.scenario, 'TIMS_PORTFOLIO' AS scenario_type,
               SUM(v.qty * v.price * g.scenario) AS portfolio_pnl
        FROM valued v, grid_moves g GROUP BY v.account_id, g.scenario""",
    "returns": """
        SELECT symbol, ts, l_orderkey, l_linenumber, l_suppkey, price,
               (price - LAG(price) OVER w) / NULLIF(LAG(price) OVER w, 0) AS ret
        FROM prices
        WINDOW w AS (PARTITION BY symbol ORDER BY ts, l_orderkey, l_linenumber, l_suppkey, price)""",
    "volatilities": """
        SELECT symbol, ts, l_orderkey, l_linenumber, l_suppkey, price, STDDEV_SAMP(ret) OVER (
                   PARTITION BY symbol ORDER BY ts, l_orderkey, l_linenumber, l_suppkey, price
                   ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) AS volatility
        FROM returns""",
    "last_volatility": """
        SELECT symbol, volatility * SQRT(252) AS volatility_annual FROM (
            SELECT symbol, volatility, ROW_NUMBER() OVER (
                PARTITION BY symbol ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, price DESC) AS rn
            FROM volatilities) WHERE rn = 1""",
    "messages": """
        SELECT event_id AS "offset", ts, event_id % 10 AS lane, value, user_id, event_type,
               CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
               CASE WHEN event_id % 10 < 5 THEN 'fills.v1' WHEN event_id % 10 < 8 THEN 'prices.v1'
                    WHEN event_id % 10 < 9 THEN 'betas.v1' WHEN event_id // 10 % 3 = 0 THEN 'orders.v1'
                    WHEN event_id // 10 % 3 = 1 THEN 'margin.calc.v1' END AS topic,
               event_id % 50 = 0 OR (event_id % 10 = 9 AND event_id // 10 % 3 = 1) AS broken,
               event_id % 70 = 6 AS no_price, event_id % 70 = 3 AS odd_price
        FROM events""",
    # numbered snapshots: n orders an account's events
    "numbered": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY ts, event_id) AS n,
               excess >= 0 AND excess < total_mv * 5e-2 AS thin, excess < 0 AS short,
               CASE WHEN equity + beta_weighted_exposure * CAST(-0.08 AS DOUBLE) - maintenance_req < 0 THEN CAST(-0.08 AS DOUBLE)
                    WHEN equity + beta_weighted_exposure * CAST(-0.06 AS DOUBLE) - maintenance_req < 0 THEN CAST(-0.06 AS DOUBLE)
                    WHEN equity + beta_weighted_exposure * 6e-2 - maintenance_req < 0 THEN 6e-2 END AS failed_at
        FROM margin_events""",
}


def _actions(stress: bool) -> dict[str, str]:
    """CTEs f1..f3 and ``actions`` for the margin-only or the combined ladder."""
    failure = "MIN(n) FILTER (WHERE failed_at IS NOT NULL)" if stress else "CAST(NULL AS BIGINT)"
    return {
        "f1": f"""
        SELECT account_id, {failure} AS n_fail, MIN(n) FILTER (WHERE short) AS n_short, MIN(n) FILTER (WHERE thin) AS n_thin
        FROM numbered GROUP BY account_id""",
        "f2": """
        SELECT f.account_id, n_fail,
               CASE WHEN n_short <= COALESCE(n_fail, n_short) THEN n_short END AS n_call,
               CASE WHEN n_thin < COALESCE(n_short, n_thin + 1) AND n_thin <= COALESCE(n_fail, n_thin) THEN n_thin END AS n_warn
        FROM f1 f""",
        "f3": """
        SELECT f.account_id, ANY_VALUE(n_fail) AS n_fail, ANY_VALUE(n_call) AS n_call, ANY_VALUE(n_warn) AS n_warn,
               ANY_VALUE(c.ts) AS issued_at,
               MIN(e.n) FILTER (WHERE e.short AND e.ts > c.ts + INTERVAL 30 MINUTES AND e.n <= COALESCE(n_fail, e.n)) AS n_restr
        FROM f2 f LEFT JOIN numbered c ON c.account_id = f.account_id AND c.n = f.n_call
                  LEFT JOIN numbered e ON e.account_id = f.account_id
        GROUP BY f.account_id""",
        "actions": """
        SELECT e.account_id, e.ts, e.event_id, a.event_type, a.status, a.topic, a.action, a.trigger,
               CASE WHEN a.event_type IN ('WARNING_ISSUED', 'STRESS_RESTRICTION') THEN NULL ELSE -e.excess END AS deficiency,
               CASE WHEN a.event_type <> 'STRESS_RESTRICTION' THEN e.excess END AS excess,
               CASE WHEN a.event_type <> 'STRESS_RESTRICTION' THEN e.equity END AS equity,
               CASE WHEN a.event_type <> 'STRESS_RESTRICTION' THEN e.total_mv END AS total_mv,
               CASE WHEN a.event_type <> 'STRESS_RESTRICTION' THEN e.maintenance_req END AS maintenance_req,
               CASE WHEN a.event_type = 'STRESS_RESTRICTION' THEN e.failed_at END AS scenario,
               CASE WHEN a.event_type = 'STRESS_RESTRICTION'
                    THEN e.equity + e.beta_weighted_exposure * e.failed_at - e.maintenance_req END AS excess_stressed,
               CASE WHEN a.event_type IN ('MARGIN_CALL_ISSUED', 'RESTRICTION_APPLIED', 'LIQUIDATION_TRIGGERED')
                    THEN a.issued_at END AS margin_call_issued_at,
               CASE WHEN a.event_type = 'RESTRICTION_APPLIED' THEN 'Margin call outstanding for '
                        || printf('%.0f', date_diff('microsecond', a.issued_at, e.ts) / 6e7) || ' minutes'
                    WHEN a.event_type = 'STRESS_RESTRICTION' THEN 'Underwater in SPY '
                        || printf('%.1f', e.failed_at * 100) || '% stress scenario' END AS reason,
               sha256('event|' || e.account_id || '|' || e.event_id) AS correlation_id,
               sha256('audit|' || a.event_type || '|' || e.account_id || '|' || e.event_id) AS audit_id
        FROM (
            SELECT account_id, n_warn AS n, issued_at, 'WARNING_ISSUED' AS event_type, 'WARNING' AS status,
                   'margin.calls.v1' AS topic, 'WARNING' AS action, CAST(NULL AS VARCHAR) AS trigger FROM f3
            UNION ALL SELECT account_id, n_call, issued_at, 'MARGIN_CALL_ISSUED', 'MARGIN_CALL', 'margin.calls.v1',
                   'MARGIN_CALL', NULL FROM f3
            UNION ALL SELECT account_id, n_restr, issued_at, 'RESTRICTION_APPLIED', 'RESTRICTED', 'restrictions.v1',
                   'CLOSE_ONLY', NULL FROM f3
            UNION ALL SELECT f.account_id, n_restr, issued_at, 'LIQUIDATION_TRIGGERED', 'RESTRICTED', 'liquidations.v1',
                   NULL, 'SEVERE_DEFICIENCY'
              FROM f3 f JOIN numbered e ON e.account_id = f.account_id AND e.n = f.n_restr
              WHERE -e.excess > e.maintenance_req * 5e-1
            UNION ALL SELECT account_id, n_fail, issued_at, 'STRESS_RESTRICTION', 'RESTRICTED', 'restrictions.v1',
                   'CLOSE_ONLY', NULL FROM f3 WHERE n_restr IS NULL) a
        JOIN numbered e ON e.account_id = a.account_id AND e.n = a.n""",
        "state_rows": """
        SELECT account_id, ts, status, equity, total_mv AS market_value, maintenance_req, excess, margin_call_issued_at,
               event_type AS last_action, scenario AS stress_scenario, excess_stressed, ts + INTERVAL 30 DAYS AS ttl,
               ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY ts DESC,
                   CASE status WHEN 'WARNING' THEN 1 WHEN 'MARGIN_CALL' THEN 2 ELSE 3 END DESC) AS rn
        FROM actions WHERE event_type <> 'LIQUIDATION_TRIGGERED'""",
    }


FILLS = ("fills",)
PRICES = ("fills", "prices")
VALUED = ("fills", "prices", "betas", "positions", "last_price", "valued")
TOTALS = (*VALUED, "totals")
FLAT = (*TOTALS, "margin_flat")
CASH = (*TOTALS, "cash", "margin_cash")
STRESS_FLAT = (*FLAT, "index_moves", "stress_flat")
STRESS_CASH = (*CASH, "index_moves", "stress_cash")
RETURNS = (*PRICES, "returns")
LADDER = ("margin_events", "numbered")

MARGIN = """account_id, ROUND(total_mv, 8) AS total_mv, ROUND(beta_weighted_exposure, 8) AS beta_weighted_exposure,
    ROUND(cash, 8) AS cash, ROUND(equity, 8) AS equity, ROUND(maintenance_req, 8) AS maintenance_req,
    ROUND(excess, 8) AS excess, ROUND(excess_pct, 6) AS excess_pct"""
STRESS = """account_id, scenario, scenario_type, CASE WHEN delta_pnl = 0 THEN 0.0 ELSE ROUND(delta_pnl, 8) END AS delta_pnl,
    ROUND(equity_stressed, 8) AS equity_stressed, ROUND(excess_stressed, 8) AS excess_stressed,
    excess_stressed < 0 AS underwater"""
ACTION = """account_id, ts, event_id, event_type, status, ROUND(deficiency, 8) AS deficiency,
    ROUND(excess, 8) AS excess, scenario, ROUND(excess_stressed, 8) AS excess_stressed, margin_call_issued_at"""
CONTROL = """topic, account_id, action, trigger, reason, ROUND(deficiency, 8) AS deficiency,
    CASE WHEN topic = 'margin.calls.v1' THEN ROUND(excess, 8) END AS excess,
    CASE WHEN topic = 'margin.calls.v1' THEN ROUND(equity, 8) END AS equity,
    CASE WHEN topic = 'margin.calls.v1' THEN ROUND(maintenance_req, 8) END AS maintenance_req,
    scenario, ROUND(excess_stressed, 8) AS excess_stressed, ts AS "timestamp", correlation_id"""


# per call the fills up to it, newest first, with the first one of the same position
LAST_FILL = """SELECT c.account_id, c.ts AS call_ts, m.symbol, m.ts,
        MIN(m.ts) OVER (PARTITION BY c.account_id, m.symbol) AS opening_fill_ts,
        ROW_NUMBER() OVER (PARTITION BY c.account_id
            ORDER BY m.ts DESC, m.l_orderkey DESC, m.l_linenumber DESC, m.l_suppkey DESC) AS rn
    FROM actions c JOIN in_month m ON m.account_id = c.account_id AND m.ts <= c.ts
    WHERE c.event_type = 'MARGIN_CALL_ISSUED'"""


def _with(names: tuple[str, ...], body: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{n} AS ({CTE[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _ladder(body: str, stress: bool = False, names: tuple[str, ...] = ()) -> str:
    return _with((*names, *LADDER), body, _actions(stress))


def _expiry() -> str:
    """The combined ladder one snapshot at a time; a state written 30 days ago or more is forgotten."""
    walk = """
        SELECT DISTINCT account_id, CAST(0 AS BIGINT) AS n, 'ACTIVE' AS status, CAST(NULL AS TIMESTAMP) AS issued,
               CAST(NULL AS TIMESTAMP) AS wrote, CAST(NULL AS VARCHAR) AS step, FALSE AS stressed
        FROM numbered
        UNION ALL
        SELECT account_id, n,
               CASE WHEN stressed OR step = 'RESTRICTION_APPLIED' THEN 'RESTRICTED' WHEN step = 'MARGIN_CALL_ISSUED'
                    THEN 'MARGIN_CALL' WHEN step = 'WARNING_ISSUED' THEN 'WARNING' ELSE status END,
               CASE WHEN step = 'MARGIN_CALL_ISSUED' THEN ts ELSE issued END,
               CASE WHEN stressed OR step IS NOT NULL THEN ts ELSE wrote END, step, stressed
        FROM (SELECT *, failed_at IS NOT NULL AND status <> 'RESTRICTED'
                     AND step IS DISTINCT FROM 'RESTRICTION_APPLIED' AS stressed
              FROM (SELECT *, CASE WHEN thin AND status = 'ACTIVE' THEN 'WARNING_ISSUED'
                                   WHEN short AND status IN ('ACTIVE', 'WARNING') THEN 'MARGIN_CALL_ISSUED'
                                   WHEN short AND status = 'MARGIN_CALL' AND ts > issued + INTERVAL 30 MINUTES
                                        THEN 'RESTRICTION_APPLIED' END AS step
                    FROM (SELECT e.account_id, e.n, e.ts, e.thin, e.short, e.failed_at, w.issued, w.wrote,
                                 CASE WHEN w.wrote + INTERVAL 30 DAYS > e.ts THEN w.status ELSE 'ACTIVE' END AS status
                          FROM walk w JOIN numbered e ON e.account_id = w.account_id AND e.n = w.n + 1)))"""
    numbered = CTE["numbered"].replace("FROM margin_events", "FROM spread")
    return f"""WITH RECURSIVE margin_events AS ({CTE["margin_events"]}),
    spread AS (SELECT * REPLACE (ts + to_days(CAST(event_id % 5 * 20 AS INTEGER)) AS ts) FROM margin_events),
    numbered AS ({numbered}),
    walk AS ({walk}),
    steps AS (
        SELECT account_id, n, issued, step AS event_type, CASE step WHEN 'WARNING_ISSUED' THEN 'WARNING'
                   WHEN 'MARGIN_CALL_ISSUED' THEN 'MARGIN_CALL' ELSE 'RESTRICTED' END AS status
        FROM walk WHERE step IS NOT NULL
        UNION ALL SELECT w.account_id, w.n, w.issued, 'LIQUIDATION_TRIGGERED', 'RESTRICTED'
        FROM walk w JOIN numbered e ON e.account_id = w.account_id AND e.n = w.n
        WHERE w.step = 'RESTRICTION_APPLIED' AND -e.excess > e.maintenance_req * 0.5
        UNION ALL SELECT account_id, n, NULL, 'STRESS_RESTRICTION', 'RESTRICTED' FROM walk WHERE stressed)
    SELECT s.account_id, e.ts, e.event_id, s.event_type, s.status,
           CASE WHEN s.event_type NOT IN ('WARNING_ISSUED', 'STRESS_RESTRICTION') THEN ROUND(-e.excess, 8) END AS deficiency,
           CASE WHEN s.event_type <> 'STRESS_RESTRICTION' THEN ROUND(e.excess, 8) END AS excess,
           CASE WHEN s.event_type = 'STRESS_RESTRICTION' THEN e.failed_at END AS scenario,
           CASE WHEN s.event_type = 'STRESS_RESTRICTION' THEN ROUND(e.equity + e.beta_weighted_exposure * e.failed_at
               - e.maintenance_req, 8) END AS excess_stressed,
           CASE WHEN s.event_type NOT IN ('WARNING_ISSUED', 'STRESS_RESTRICTION') THEN s.issued END AS margin_call_issued_at
    FROM steps s JOIN numbered e ON e.account_id = s.account_id AND e.n = s.n"""


def _fixed(column: str) -> str:
    """Two decimals, or a dash where unknown."""
    return f"COALESCE(CAST(ROUND(CAST({column} AS DECIMAL(24, 6)), 2) AS VARCHAR), '-')"


def _both_ladders(columns: str) -> str:
    margin = _ladder(f"SELECT {columns}, 'margin' AS variant FROM actions")
    combined = _ladder(f"SELECT {columns}, 'combined' AS variant FROM actions", True)
    return f"SELECT * FROM ({margin}) UNION ALL SELECT * FROM ({combined})"


def _shock_path() -> str:
    moves, factors, rows = (0.0, 0.01, -0.005, -0.02, -0.03, -0.01), "price", []
    for step, number in enumerate(moves):
        move = f"CAST({number} AS DOUBLE)"  # SQL reads plain decimals as DECIMAL
        factors += f" * (1 + beta * {move})"
        rows.append(f"SELECT {step} AS step, {move} AS market_move, {factors} AS shocked_price")
    return " UNION ALL ".join(rows)


# fills with the part of the margin feed in which they are first delivered, and totals after each of the first two parts
DELIVERED = {
    "sent": """
        SELECT *, CASE WHEN ts <= TIMESTAMP '1998-06-01 00:00:00' THEN 0 ELSE 1 END
                  + CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS part FROM fills""",
    "upto": "SELECT unnest([0, 1]) AS k",
    "known_price": """
        SELECT k, symbol, ARG_MAX(price, (ts, l_orderkey, l_linenumber, l_suppkey, price)) AS price
        FROM sent JOIN upto ON part <= k GROUP BY k, symbol""",
    "known_position": """
        SELECT k, account_id, symbol, CAST(SUM(qty) AS BIGINT) AS qty FROM sent JOIN upto ON part <= k GROUP BY ALL""",
}


def _clock() -> str:
    """The margin ladder with the clock: an open call whose last snapshot was short is escalated when its time is up."""
    return _with(
        LADDER,
        f"""SELECT {ACTION} FROM (
              SELECT n.account_id, n.ts, n.event_id, 'WARNING_ISSUED' AS event_type, 'WARNING' AS status, CAST(NULL AS DOUBLE) AS deficiency,
                     n.excess, CAST(NULL AS DOUBLE) AS scenario, CAST(NULL AS DOUBLE) AS excess_stressed, CAST(NULL AS TIMESTAMP) AS margin_call_issued_at
              FROM firsts f JOIN numbered n ON n.account_id = f.account_id AND n.n = f.n_thin WHERE f.n_short IS NULL OR f.n_thin < f.n_short
              UNION ALL
              SELECT n.account_id, n.ts, n.event_id, 'MARGIN_CALL_ISSUED', 'MARGIN_CALL', -n.excess, n.excess, NULL, NULL, n.ts
              FROM firsts f JOIN numbered n ON n.account_id = f.account_id AND n.n = f.n_short
              UNION ALL
              SELECT n.account_id, COALESCE(r.at, n.ts), n.event_id, kind, 'RESTRICTED', -n.excess, n.excess, NULL, NULL, r.called_at
              FROM restricted r JOIN numbered n ON n.account_id = r.account_id AND n.n = r.n
              JOIN (SELECT unnest(['RESTRICTION_APPLIED', 'LIQUIDATION_TRIGGERED']) AS kind) k
                ON kind = 'RESTRICTION_APPLIED' OR -n.excess > n.maintenance_req * 0.5)""",
        {
            "firsts": """
        SELECT account_id, MIN(n) FILTER (WHERE short) AS n_short, MIN(n) FILTER (WHERE thin) AS n_thin FROM numbered GROUP BY account_id""",
            "calls": """
        SELECT n.account_id, n.ts AS called_at, n.ts + INTERVAL 30 MINUTES AS due
        FROM firsts f JOIN numbered n ON n.account_id = f.account_id AND n.n = f.n_short""",
            "met": """
        SELECT c.account_id, c.called_at, c.due, MAX(n.n) FILTER (WHERE n.ts <= c.due) AS n_last,
               MIN(n.n) FILTER (WHERE n.ts > c.due AND n.short) AS n_next, COUNT(*) FILTER (WHERE n.ts > c.due) AS later
        FROM calls c JOIN numbered n ON n.account_id = c.account_id GROUP BY ALL""",
            "restricted": """
        SELECT m.account_id, m.called_at, CASE WHEN l.short THEN m.due END AS at,
               CASE WHEN NOT l.short THEN m.n_next
                    WHEN m.later > 0 OR m.due < (SELECT MAX(ts) - INTERVAL 5 SECONDS FROM margin_events) THEN m.n_last END AS n
        FROM met m JOIN numbered l ON l.account_id = m.account_id AND l.n = m.n_last""",
        },
    )


def statements() -> dict[str, str]:
    """Streams give what the batch query of the same meaning gives."""
    own = _statements()
    same = {
        "stream_margin_delta": "account_margin",
        "stream_volatility": "latest_volatility",
        "stream_asof": "asof_fill_price",
        "stream_ladder_state": "ladder_margin",
        "backtest_stream": "backtest_summary",
    }
    return {**own, **{stream: own[batch] for stream, batch in same.items()}}


def _statements() -> dict[str, str]:
    dead = _with(
        ("messages",),
        """SELECT topic, CASE WHEN lane < 5 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS key, "offset",
                  CASE WHEN topic = 'orders.v1' OR topic IS NULL THEN 'UNKNOWN_TOPIC' WHEN broken THEN 'MALFORMED'
                       WHEN no_price THEN 'MISSING_FIELD' ELSE 'MISTYPED_FIELD' END AS reason
           FROM messages WHERE topic = 'orders.v1' OR topic IS NULL OR broken OR no_price OR odd_price""",
    )
    return {
        "decode_events": _with(
            ("messages",),
            """SELECT "offset", CAST(user_id AS VARCHAR) AS account_id, event_type AS symbol, k AS qty, value AS price,
                      epoch_us(ts) // 1000 AS "timestamp", CAST("offset" AS VARCHAR) AS fill_id
               FROM messages WHERE topic = 'fills.v1' AND NOT broken AND NOT odd_price""",
        ),
        "route_by_topic": _with(
            ("messages",),
            """SELECT topic, CASE WHEN topic = 'orders.v1' OR topic IS NULL THEN 'dead' ELSE topic END AS route, COUNT(*) AS messages,
                      MIN("offset") AS first, MAX("offset") AS last FROM messages GROUP BY topic""",
        ),
        "dead_letters": dead,
        "stream_dead_letters": dead,
        "dedup_fills": """
            SELECT sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                       CAST(FLOOR(l_quantity * 100 + 5e-1) AS BIGINT), CAST(FLOOR(l_extendedprice * 100 + 5e-1) AS BIGINT),
                       CAST(FLOOR(l_discount * 100 + 5e-1) AS BIGINT), CAST(FLOOR(l_tax * 100 + 5e-1) AS BIGINT),
                       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS fill_id,
                   l_partkey AS symbol,
                   CAST(l_quantity AS INTEGER) * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS qty,
                   l_shipdate AS ts
            FROM (SELECT DISTINCT * FROM lineitem)""",
        "backtest_replay": _with(
            PRICES, 'SELECT ts AS "timestamp", CAST(symbol AS VARCHAR) AS symbol, price FROM prices'
        ),
        "audit_scan_pruned": _ladder(
            """SELECT CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS hour, event_type, COUNT(*) AS events,
                      COUNT(deficiency) AS with_deficiency, COUNT(DISTINCT event_id) AS causes
               FROM actions WHERE CAST(ts AS DATE) = DATE '2024-01-16' GROUP BY 1, 2"""
        ),
        "audit_partitions": _ladder(
            """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
                      strftime(ts, '%H') AS hour, COUNT(*) AS events FROM actions GROUP BY 1, 2, 3, 4""",
            True,
        ),
        "scenario_table": _with(
            (*TOTALS, "index_moves", "grid_moves"),
            """SELECT scenario, 'SPY_BETA_WEIGHTED' AS scenario_type,
                      ROUND((SELECT SUM(beta_weighted_exposure) FROM totals) * scenario, 1) + 0.0 AS total_pnl FROM index_moves
               UNION ALL
               SELECT scenario, 'TIMS_PORTFOLIO', ROUND((SELECT SUM(total_mv) FROM totals) * scenario, 1) FROM grid_moves""",
        ),
        "account_cash": _with(
            ("fills", "cash"),
            """SELECT c.account_id, ROUND(c.cash, 8) AS cash, LOWER(r.c_mktsegment) AS risk_profile
               FROM cash c JOIN customer r ON r.c_custkey = c.account_id""",
        ),
        "net_positions": _with(("fills", "positions"), "SELECT * FROM positions"),
        "open_positions": _with(("fills", "positions"), "SELECT * FROM positions WHERE qty <> 0"),
        "latest_price": _with((*PRICES, "last_price"), "SELECT symbol, price FROM last_price"),
        "latest_price_rn": _with((*PRICES, "last_price"), "SELECT symbol, price, ts FROM last_price"),
        "latest_beta": """
            SELECT symbol, beta FROM (
                SELECT l_partkey AS symbol, 0.5 + l_tax * 10 AS beta, ROW_NUMBER() OVER (PARTITION BY l_partkey
                    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_tax DESC) AS rn
                FROM lineitem) WHERE rn = 1""",
        "positions_valued": _with(VALUED, "SELECT * FROM valued"),
        "positions_valued_nulls": _with(
            (*PRICES, "betas", "positions", "last_price", "gap_prices", "gap_betas"),
            """SELECT p.account_id, p.symbol, p.qty, pr.price, b.beta, p.qty * pr.price AS market_value,
                      p.qty * pr.price * b.beta AS beta_weighted_value
               FROM positions p LEFT JOIN gap_prices pr ON pr.symbol = p.symbol LEFT JOIN gap_betas b ON b.symbol = p.symbol""",
        ),
        "positions_valued_fill_price": _with(
            (*PRICES, "betas", "positions", "last_price", "gap_prices", "gap_betas"),
            """SELECT p.account_id, p.symbol, p.qty, f.price AS fill_price, COALESCE(pr.price, f.price) AS price,
                      COALESCE(b.beta, 1.0) AS beta, p.qty * COALESCE(pr.price, f.price) AS market_value,
                      p.qty * COALESCE(pr.price, f.price) * COALESCE(b.beta, 1.0) AS beta_weighted_value
               FROM positions p
               JOIN (SELECT account_id, symbol, price, ROW_NUMBER() OVER (PARTITION BY account_id, symbol ORDER BY
                         ts DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, price DESC) AS rn FROM fills) f
                 ON f.account_id = p.account_id AND f.symbol = p.symbol AND f.rn = 1
               LEFT JOIN gap_prices pr ON pr.symbol = p.symbol LEFT JOIN gap_betas b ON b.symbol = p.symbol""",
        ),
        "position_weights": _with(
            VALUED,
            """SELECT account_id, symbol, market_value, ROUND(t, 8) AS total_mv,
                      CASE WHEN market_value = 0 THEN 0.0 ELSE ROUND(market_value / NULLIF(t, 0), 6) END AS weight
               FROM (SELECT *, SUM(market_value) OVER (PARTITION BY account_id) AS t FROM valued WHERE qty <> 0)""",
        ),
        "account_margin": _with(FLAT, f"SELECT {MARGIN} FROM margin_flat"),
        "account_margin_cash": _with(CASH, f"SELECT {MARGIN} FROM margin_cash"),
        "account_margin_gross": _with(
            CASH,
            """SELECT account_id, ROUND(total_mv, 8) AS total_mv, ROUND(beta_weighted_exposure, 8) AS beta_weighted_exposure,
                      ROUND(cash, 8) AS cash, ROUND(equity, 8) AS equity, ROUND(ABS(total_mv) * 0.25, 8) AS maintenance_req,
                      ROUND(equity - ABS(total_mv) * 0.25, 8) AS excess,
                      ROUND((equity - ABS(total_mv) * 0.25) / NULLIF(total_mv, 0), 6) AS excess_pct
               FROM margin_cash""",
        ),
        "house_margin": _with(
            CASH,
            """SELECT account_id, ROUND(total_mv, 8) AS total_mv, ROUND(beta_weighted_exposure, 8) AS beta_weighted_exposure,
                      ROUND(cash, 8) AS cash, ROUND(equity, 8) AS equity, ROUND(total_mv * 0.3, 8) AS maintenance_req,
                      ROUND(equity - total_mv * 0.3, 8) AS excess,
                      ROUND((equity - total_mv * 0.3) / NULLIF(total_mv, 0), 6) AS excess_pct
               FROM margin_cash""",
        ),
        "margin_deficiency": _with(
            CASH,
            "SELECT account_id, ROUND(excess, 8) AS excess, ROUND(ABS(excess), 8) AS deficiency FROM margin_cash WHERE excess < 0",
        ),
        "account_standing": _with(
            CASH,
            """SELECT account_id, CASE WHEN excess < 0 THEN 'DEFICIENT' WHEN excess < total_mv * 0.05 THEN 'WARNING'
                      ELSE 'GOOD' END AS standing FROM margin_cash""",
        ),
        "market_leverage": _with(
            FLAT,
            "SELECT account_id, ROUND(beta_weighted_exposure / NULLIF(total_mv, 0), 6) AS market_leverage FROM margin_flat",
        ),
        "initial_margin": _with(
            FILLS,
            """SELECT account_id, ROUND(SUM(CASE WHEN qty > 0 THEN qty * price ELSE 0.0 END), 8) AS purchases,
                      ROUND(SUM(CASE WHEN qty > 0 THEN qty * price ELSE 0.0 END) * 0.5, 8) AS initial_margin
               FROM fills GROUP BY account_id""",
        ),
        "leverage_overlay": _with(
            CASH,
            """SELECT account_id, ROUND(total_mv, 8) AS total_mv,
                      ROUND(beta_weighted_exposure / NULLIF(equity, 0), 6) AS leverage,
                      ROUND(CASE WHEN beta_weighted_exposure / NULLIF(equity, 0) > 2 THEN total_mv * 0.05 ELSE 0.0 END, 8)
                          AS leverage_addon
               FROM margin_cash""",
        ),
        "concentration_margin": _with(
            VALUED,
            """SELECT account_id, ROUND(SUM(market_value), 8) AS total_mv, ROUND(SUM(addon), 8) AS concentration_addon,
                      ROUND(SUM(market_value) * 0.25 + SUM(addon), 8) AS maintenance_req
               FROM (SELECT account_id, market_value, CASE WHEN market_value / NULLIF(SUM(market_value)
                         OVER (PARTITION BY account_id), 0) > 0.3 THEN market_value * 0.1 ELSE 0.0 END AS addon FROM valued)
               GROUP BY account_id""",
        ),
        "volatility_margin": _with(
            (*VALUED, "returns", "volatilities", "last_volatility"),
            """SELECT account_id, ROUND(SUM(market_value), 8) AS total_mv, ROUND(SUM(addon), 8) AS volatility_addon,
                      ROUND(SUM(market_value) * 0.25 + SUM(addon), 8) AS maintenance_req
               FROM (SELECT v.account_id, v.market_value,
                            CASE WHEN COALESCE(l.volatility_annual, 0.2) > 0.6 THEN v.market_value * 0.1
                                 WHEN COALESCE(l.volatility_annual, 0.2) > 0.4 THEN v.market_value * 0.05 ELSE 0.0 END AS addon
                     FROM valued v LEFT JOIN last_volatility l ON l.symbol = v.symbol)
               GROUP BY account_id""",
        ),
        "low_price_margin": _with(
            VALUED,
            """SELECT account_id, ROUND(SUM(market_value), 8) AS total_mv,
                      ROUND(SUM(CASE WHEN price < 5 THEN market_value ELSE market_value * 0.25 END), 8) AS maintenance_req,
                      COUNT(*) FILTER (WHERE price < 5) AS low_priced
               FROM valued GROUP BY account_id""",
        ),
        "beta_stress": _with(STRESS_FLAT, f"SELECT {STRESS} FROM stress_flat"),
        "beta_stress_cash": _with(STRESS_CASH, f"SELECT {STRESS} FROM stress_cash"),
        "severe_underwater": _with(
            STRESS_CASH, f"SELECT {STRESS} FROM stress_cash WHERE excess_stressed < 0 AND ABS(scenario) >= 6e-2"
        ),
        **{
            name: _with(
                (*VALUED, "grid_moves", "grid"),
                "SELECT account_id, ROUND(portfolio_pnl, 8) AS portfolio_pnl, scenario, scenario_type FROM grid",
            )
            for name in ("grid_pnl", "grid_pnl_by_position")
        },
        "portfolio_margin": _with(
            (*VALUED, "grid_moves", "grid"),
            """SELECT account_id, ROUND(MIN(portfolio_pnl), 8) AS worst_case_loss,
                      ARG_MIN(scenario, portfolio_pnl) AS worst_scenario,
                      ROUND(ABS(MIN(portfolio_pnl)), 8) AS portfolio_margin_req
               FROM grid GROUP BY account_id""",
        ),
        "margin_comparison": _with(
            (*TOTALS, "grid_moves", "grid"),
            """SELECT t.account_id, ROUND(total_mv, 8) AS total_mv, ROUND(total_mv * 0.25, 8) AS reg_t_margin,
                      ROUND(req, 8) AS portfolio_margin_req,
                      CASE WHEN req < total_mv * 0.25 THEN 'PORTFOLIO' ELSE 'REG_T' END AS margin_method,
                      ROUND(total_mv * 0.25 - req, 8) AS margin_savings
               FROM totals t LEFT JOIN (SELECT account_id, ABS(MIN(portfolio_pnl)) AS req FROM grid GROUP BY account_id) g
                 ON g.account_id = t.account_id""",
        ),
        "all_scenarios": _with(
            (*STRESS_FLAT, "grid_moves", "grid"),
            """SELECT account_id, scenario, scenario_type, CASE WHEN delta_pnl = 0 THEN 0.0 ELSE ROUND(delta_pnl, 8) END AS delta_pnl,
                      ROUND(excess_stressed, 8) AS excess_stressed, CAST(NULL AS DOUBLE) AS portfolio_pnl FROM stress_flat
               UNION ALL
               SELECT account_id, scenario, scenario_type, NULL, NULL, ROUND(portfolio_pnl, 8) FROM grid""",
        ),
        "firm_risk": _with(
            FLAT,
            """SELECT ROUND(SUM(beta_weighted_exposure), 1) AS firm_beta_weighted_exposure,
                      ROUND(SUM(total_mv), 1) AS firm_total_mv, COUNT(*) AS num_accounts FROM margin_flat""",
        ),
        "firm_stress": _with(
            (*FLAT, "index_moves"),
            """SELECT scenario, num_accounts, ROUND(e * scenario, 1) AS firm_delta_pnl, e > 10000000 AS limit_breached
               FROM (SELECT SUM(beta_weighted_exposure) AS e, COUNT(*) AS num_accounts FROM margin_flat), index_moves""",
        ),
        "firm_limit_alert": _with(
            FLAT,
            """SELECT ROUND(e, 1) AS firm_beta_weighted_exposure, ROUND(v, 1) AS firm_total_mv, num_accounts,
                      CAST(10000000 AS DOUBLE) AS firm_limit
               FROM (SELECT SUM(beta_weighted_exposure) AS e, SUM(total_mv) AS v, COUNT(*) AS num_accounts FROM margin_flat)
               WHERE e > 10000000""",
        ),
        "margin_distribution": _with(
            CASH,
            """SELECT CAST(FLOOR(excess_pct / 0.05) AS BIGINT) AS band, COUNT(*) AS accounts,
                      ROUND(SUM(total_mv), 5) AS total_mv FROM margin_cash GROUP BY 1""",
        ),
        "stress_pass_rate": _with(
            STRESS_CASH,
            """SELECT scenario, COUNT(*) AS accounts, COUNT(*) FILTER (WHERE excess_stressed < 0) AS underwater,
                      ROUND(AVG(CASE WHEN excess_stressed < 0 THEN 1 ELSE 0 END), 6) AS fail_rate
               FROM stress_cash GROUP BY scenario""",
        ),
        "price_returns": _with(
            RETURNS, 'SELECT symbol, ts, l_orderkey, l_linenumber, price, ret AS "return" FROM returns'
        ),
        "rolling_volatility": _with(
            (*RETURNS, "volatilities"),
            """SELECT symbol, ts, l_orderkey, l_linenumber, ROUND(volatility, 6) AS volatility,
                      ROUND(volatility * SQRT(252), 6) AS volatility_annual FROM volatilities""",
        ),
        "latest_volatility": _with(
            (*RETURNS, "volatilities", "last_volatility"),
            "SELECT symbol, ROUND(volatility_annual, 6) AS volatility_annual FROM last_volatility",
        ),
        "estimated_beta": _with(
            PRICES,
            """SELECT symbol, COUNT(*) AS observations,
                      ROUND(COVAR_SAMP(r, m) / NULLIF(VAR_SAMP(m), 0), 4) AS estimated_beta
               FROM (SELECT symbol, r, AVG(r) OVER (PARTITION BY day) AS m
                     FROM (SELECT symbol, day, (price - LAG(price) OVER w) / NULLIF(LAG(price) OVER w, 0) AS r
                           FROM (SELECT symbol, CAST(ts AS DATE) AS day, ARG_MAX(price, (ts, l_orderkey, l_linenumber, l_suppkey, price)) AS price
                                 FROM prices GROUP BY ALL) WINDOW w AS (PARTITION BY symbol ORDER BY day)) WHERE r IS NOT NULL)
               GROUP BY symbol""",
        ),
        "shocked_prices": _with(
            (*PRICES, "betas", "last_price"),
            f"""SELECT symbol, step, market_move, shocked_price
                FROM (SELECT p.symbol, p.price, COALESCE(b.beta, 1.0) AS beta FROM last_price p
                      LEFT JOIN betas b ON b.symbol = p.symbol), LATERAL ({_shock_path()})""",
        ),
        "asof_fill_price": _with(
            PRICES,
            """SELECT f.account_id, f.symbol, f.ts, f.l_orderkey, f.l_linenumber, f.qty, f.price, t.price AS mark
               FROM fills f ASOF LEFT JOIN (
                   SELECT symbol, ts, ARG_MAX(price, (l_orderkey, l_linenumber, l_suppkey, price)) AS price
                   FROM prices GROUP BY symbol, ts) t
               ON f.symbol = t.symbol AND f.ts >= t.ts""",
        ),
        "asof_prior_price": _with(
            PRICES,
            """SELECT f.account_id, f.symbol, f.ts, f.l_orderkey, f.l_linenumber, f.qty, f.price, t.price AS prior_mark
               FROM fills f ASOF LEFT JOIN (
                   SELECT symbol, ts, ARG_MAX(price, (l_orderkey, l_linenumber, l_suppkey, price)) AS price
                   FROM prices GROUP BY symbol, ts) t
               ON f.symbol = t.symbol AND f.ts > t.ts""",
        ),
        "ladder_margin": _ladder(f"SELECT {ACTION} FROM actions"),
        "ladder_expiry": _expiry(),
        "ladder_combined": _ladder(f"SELECT {ACTION} FROM actions", True),
        "warning_candidates": _with(
            ("margin_events",),
            """SELECT event_id, account_id, ts, total_mv, ROUND(excess, 8) AS excess FROM margin_events
               WHERE excess >= 0 AND excess < total_mv * 0.05""",
        ),
        "control_events": (
            f"SELECT * FROM ({_ladder(f'SELECT {CONTROL} FROM actions')}) UNION ALL "
            f"SELECT * FROM ({_ladder(f'SELECT {CONTROL} FROM actions', True)})"
        ),
        "audit_events": _ladder(
            """SELECT audit_id AS event_id, event_type, account_id, ts AS "timestamp", ROUND(deficiency, 8) AS deficiency,
                      CASE WHEN topic = 'margin.calls.v1' THEN ROUND(excess, 8) END AS excess,
                      CASE WHEN event_type = 'WARNING_ISSUED'
                           THEN ROUND(CASE WHEN total_mv > 0 THEN excess / total_mv ELSE 0 END, 6) END AS excess_pct,
                      CASE WHEN topic = 'margin.calls.v1' THEN ROUND(equity, 8) END AS equity,
                      CASE WHEN topic = 'margin.calls.v1' THEN ROUND(maintenance_req, 8) END AS maintenance_req,
                      CASE WHEN event_type = 'RESTRICTION_APPLIED'
                           THEN ROUND(date_diff('microsecond', margin_call_issued_at, ts) / 6e7, 6) END AS elapsed_minutes,
                      scenario, ROUND(excess_stressed, 8) AS excess_stressed,
                      CASE WHEN event_type IN ('RESTRICTION_APPLIED', 'STRESS_RESTRICTION') THEN action END AS action,
                      CASE WHEN event_type = 'LIQUIDATION_TRIGGERED' THEN trigger END AS trigger,
                      CASE event_type WHEN 'RESTRICTION_APPLIED' THEN 'Margin call escalation'
                                      WHEN 'STRESS_RESTRICTION' THEN 'Stress test failure' END AS reason,
                      correlation_id, CAST(event_id AS VARCHAR) AS causation_id FROM actions""",
            True,
        ),
        "audit_by_account": _ladder(
            """SELECT account_id, ts AS "timestamp", audit_id AS event_id, ROUND(deficiency, 8) AS deficiency
               FROM actions WHERE event_type = 'MARGIN_CALL_ISSUED'"""
        ),
        "audit_by_correlation": _ladder(
            """SELECT a.correlation_id, a.ts AS "timestamp", a.event_type, a.audit_id AS event_id, a.account_id FROM actions a
               WHERE a.correlation_id IN (SELECT correlation_id FROM actions WHERE event_type = 'MARGIN_CALL_ISSUED')"""
        ),
        "audit_retained": _ladder(
            """SELECT audit_id AS event_id, ts AS "timestamp", event_type, account_id FROM actions
               WHERE ts > TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAYS""",
            True,
        ),
        "audit_counts": _ladder("SELECT event_type, COUNT(*) AS events FROM actions GROUP BY event_type"),
        "liquidated_accounts": _ladder(
            "SELECT DISTINCT account_id FROM actions WHERE event_type = 'LIQUIDATION_TRIGGERED'"
        ),
        "action_counts": _ladder(
            """SELECT strftime(ts, '%Y-%m-%d') AS day, topic, event_type, COUNT(*) AS events FROM actions GROUP BY 1, 2, 3""", True
        ),
        "backtest_summary": (
            f"""SELECT variant, event_type, scenario, COUNT(*) AS events, COUNT(DISTINCT account_id) AS accounts
                FROM ({_both_ladders('event_type, scenario, account_id')}) GROUP BY variant, event_type, scenario"""
        ),
        "call_notifications": _ladder(
            """SELECT account_id, ts, 'Margin call on account ' || account_id || ': deficiency $'
                      || format('{:,.2f}', deficiency) || '. Deposit funds or reduce positions within 30 minutes, '
                      || 'or the account becomes close-only.' AS message
               FROM actions WHERE event_type = 'MARGIN_CALL_ISSUED'"""
        ),
        "account_state_latest": _ladder(
            """SELECT account_id, ts, status, ROUND(equity, 8) AS equity, market_value, maintenance_req,
                      ROUND(excess, 8) AS excess, margin_call_issued_at, last_action, stress_scenario,
                      ROUND(excess_stressed, 8) AS excess_stressed, ttl
               FROM state_rows WHERE rn = 1""",
            True,
        ),
        "account_state_history": _ladder(
            """SELECT account_id, CAST(rn AS INTEGER) AS rn, ts, status, last_action, ROUND(excess, 8) AS excess, ttl
               FROM state_rows WHERE rn <= 10""",
            True,
        ),
        "owner_state_history": _ladder(
            """SELECT owner, CAST(rn AS INTEGER) AS rn, ts, account_id, status, last_action FROM (
                 SELECT account_id // 100 AS owner, ts, account_id, status, last_action, ROW_NUMBER() OVER (
                     PARTITION BY account_id // 100 ORDER BY ts DESC,
                     CASE status WHEN 'WARNING' THEN 1 WHEN 'MARGIN_CALL' THEN 2 ELSE 3 END DESC) AS rn
                 FROM state_rows) WHERE rn <= 10""",
            True,
        ),
        "account_state_live": _ladder(
            """SELECT account_id, ts, status, last_action, ttl FROM state_rows
               WHERE ttl > TIMESTAMP '2024-02-15 00:00:00'""",
            True,
        ),
        "state_lookup": _ladder(
            """SELECT e.event_id, e.account_id, e.ts, COALESCE(s.status, 'ACTIVE') AS status, s.margin_call_issued_at,
                      s.last_action
               FROM margin_events e LEFT JOIN state_rows s ON s.account_id = e.account_id AND s.rn = 1""",
            True,
        ),
        "trace_call": _ladder(
            f"""SELECT c.account_id, c.ts, c.correlation_id, c.event_id AS margin_event_id, c.total_mv AS margin_mv,
                      ROUND(c.deficiency, 8) AS deficiency, CAST(f.symbol AS VARCHAR) AS symbol, f.ts AS fill_ts,
                      f.opening_fill_ts, p.price AS price_in_force
               FROM actions c
               LEFT JOIN ({LAST_FILL}) f ON f.account_id = c.account_id AND f.rn = 1
               LEFT JOIN (SELECT f.account_id, m.price, ROW_NUMBER() OVER (PARTITION BY f.account_id
                              ORDER BY m.ts DESC, m.l_orderkey DESC, m.l_linenumber DESC, m.l_suppkey DESC) AS rn
                          FROM ({LAST_FILL}) f JOIN in_month m ON m.symbol = f.symbol AND m.ts <= f.call_ts
                          WHERE f.rn = 1) p ON p.account_id = c.account_id AND p.rn = 1
               WHERE c.event_type = 'MARGIN_CALL_ISSUED'""",
            names=(*FILLS, "in_month"),
        ),
        "e2e_latency": _ladder(
            f"""SELECT account_id, call_ts AS ts, ts AS fill_ts, date_diff('microsecond', ts, call_ts) / 1e6 AS latency_seconds
               FROM ({LAST_FILL}) WHERE rn = 1""",
            names=(*FILLS, "in_month"),
        ),
        "liquidation_selection": _with(
            CASH,
            """SELECT account_id, symbol, qty, beta, estimated_proceeds, ROUND(before, 8) AS proceeds_before,
                      ROUND(deficiency, 8) AS deficiency, ROUND(deficiency * 1.1, 8) AS target
               FROM (SELECT v.account_id, v.symbol, v.qty, v.beta, v.market_value AS estimated_proceeds,
                            -m.excess AS deficiency, COALESCE(SUM(v.market_value) OVER (PARTITION BY v.account_id
                                ORDER BY v.beta DESC, v.symbol ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before
                     FROM valued v JOIN margin_cash m ON m.account_id = v.account_id WHERE m.excess < 0 AND v.qty > 0)
               WHERE before < deficiency * 1.1""",
        ),
        "liquidation_order_lines": _with(
            CASH,
            """SELECT account_id, line_no, CAST(MAX(line_no) OVER (PARTITION BY account_id) // 500 + 1 AS INTEGER) AS pages,
                      'MARGIN_DEFICIENCY' AS reason, ROUND(deficiency, 8) AS deficiency,
                      TIMESTAMP '2024-02-01 00:00:00' AS "timestamp", symbol, qty, estimated_proceeds
               FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY beta DESC, symbol) - 1 AS line_no
                     FROM (SELECT v.account_id, v.symbol, v.qty, v.beta, v.market_value AS estimated_proceeds,
                                  -m.excess AS deficiency, COALESCE(SUM(v.market_value) OVER (PARTITION BY v.account_id
                                      ORDER BY v.beta DESC, v.symbol ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before
                           FROM valued v JOIN margin_cash m ON m.account_id = v.account_id WHERE m.excess < 0 AND v.qty > 0)
                     WHERE before < deficiency * 1.1)""",
        ),
        "event_display_line": _ladder(
            f"""SELECT ts, strftime(ts, '%H:%M:%S.%g') || ' fill account_id=' || account_id || ' symbol=' || symbol
                      || ' qty=' || qty || ' price=' || {_fixed('price')} AS display_line FROM fills
               UNION ALL SELECT ts, strftime(ts, '%H:%M:%S.%g') || ' price symbol=' || symbol || ' price=' || {_fixed('price')}
               FROM prices
               UNION ALL SELECT TIMESTAMP '2024-01-01', '00:00:00.000 beta symbol=' || symbol || ' beta=' || {_fixed('beta')}
               FROM betas
               UNION ALL SELECT ts, strftime(ts, '%H:%M:%S.%g') || ' margin account_id=' || account_id || ' equity='
                      || {_fixed('equity')} || ' maintenance_req=' || {_fixed('maintenance_req')} || ' excess=' || {_fixed('excess')}
               FROM margin_events
               UNION ALL SELECT TIMESTAMP '2024-01-01', '00:00:00.000 stress account_id=' || account_id || ' scenario='
                      || {_fixed('scenario')} || ' excess_stressed=' || {_fixed('excess_stressed')} || ' underwater='
                      || CASE WHEN excess_stressed < 0 THEN 'true' ELSE 'false' END
               FROM stress_flat
               UNION ALL SELECT ts, strftime(ts, '%H:%M:%S.%g') || ' audit account_id=' || account_id || ' event_type='
                      || event_type || ' correlation_id=' || correlation_id FROM actions
               UNION ALL
               SELECT ts, strftime(ts, '%H:%M:%S.%g') || CASE topic
                      WHEN 'margin.calls.v1' THEN ' call account_id=' || account_id || ' action=' || action
                          || ' deficiency=' || {_fixed('deficiency')} || ' excess=' || {_fixed('excess')}
                      WHEN 'restrictions.v1' THEN ' restriction account_id=' || account_id || ' action=' || action
                          || ' reason=' || reason || ' scenario=' || {_fixed('scenario')}
                      ELSE ' liquidation account_id=' || account_id || ' trigger=' || trigger
                          || ' deficiency=' || {_fixed('deficiency')} END
               FROM actions""",
            True,
            STRESS_FLAT,
        ),
        "stream_fills": _with(
            ("messages",),
            """SELECT CAST(user_id AS VARCHAR) AS account_id, event_type AS symbol, CAST(SUM(k) AS BIGINT) AS qty,
                      MAX(ts) AS last_updated
               FROM messages WHERE topic = 'fills.v1' AND NOT broken AND NOT odd_price GROUP BY 1, 2""",
        ),
        "stream_late": _with(
            ("messages",),
            """SELECT CAST(user_id AS VARCHAR) AS account_id, event_type AS symbol, CAST(SUM(k) AS BIGINT) AS qty
               FROM messages WHERE topic = 'fills.v1' AND NOT broken AND NOT odd_price GROUP BY 1, 2""",
        ),
        "stream_prices": _with(
            ("messages",),
            """SELECT event_type AS symbol, ARG_MAX(value, (ts, "offset")) AS price, MAX(ts) AS last_updated
               FROM messages WHERE topic = 'prices.v1' AND NOT no_price GROUP BY 1""",
        ),
        "stream_dedup": _with(
            ("messages",),
            """SELECT CAST("offset" AS VARCHAR) AS fill_id, CAST(user_id AS VARCHAR) AS account_id, event_type AS symbol,
                      k AS qty, ts FROM messages WHERE topic = 'fills.v1' AND NOT broken AND NOT odd_price""",
        ),
        "stream_state": _with(
            (*PRICES, "betas", "positions", "last_price"),
            """SELECT 'position' AS kind, CAST(account_id AS VARCHAR) AS account_id, CAST(symbol AS VARCHAR) AS symbol,
                      CAST(qty AS DOUBLE) AS qty, CAST(NULL AS DOUBLE) AS val FROM positions
               UNION ALL SELECT 'price', '', CAST(symbol AS VARCHAR), NULL, price FROM last_price
               UNION ALL SELECT 'beta', '', CAST(symbol AS VARCHAR), NULL, beta FROM betas""",
        ),
        "margin_json": _with(
            FLAT, f"SELECT CAST(account_id AS VARCHAR) AS account_id, * EXCLUDE (account_id) FROM (SELECT {MARGIN} FROM margin_flat)"
        ),
        "stress_json": _with(
            (*STRESS_FLAT, "grid_moves", "grid"),
            f"""SELECT CAST(account_id AS VARCHAR) AS account_id, CAST(underwater AS VARCHAR) AS underwater,
                       * EXCLUDE (account_id, underwater)
                FROM (SELECT {STRESS}, CAST(NULL AS DOUBLE) AS portfolio_pnl FROM stress_flat
                      UNION ALL SELECT account_id, scenario, scenario_type, NULL, NULL, NULL, NULL, ROUND(portfolio_pnl, 8)
                      FROM grid)""",
        ),
        "stream_betas": _with(
            ("messages",),
            """SELECT event_type AS symbol, ARG_MAX(CAST(k AS DOUBLE) / 50, (ts, "offset")) AS beta, MAX(ts) AS last_updated
               FROM messages WHERE topic = 'betas.v1' AND NOT broken GROUP BY 1""",
        ),
        "stream_touched_accounts": _with(
            FILLS,
            """SELECT part, COUNT(DISTINCT account_id) AS accounts FROM (
                 SELECT CAST(part AS INTEGER) AS part, account_id FROM sent WHERE part < 2
                 UNION ALL
                 SELECT 1, h.account_id FROM known_position h
                 JOIN known_price b ON b.symbol = h.symbol AND b.k = 1 LEFT JOIN known_price a ON a.symbol = h.symbol AND a.k = 0
                 WHERE h.k = 0 AND h.qty <> 0 AND b.price <> COALESCE(a.price, 0.0))
               GROUP BY part""",
            DELIVERED,
        ),
        "stream_firm_risk": _with(
            (*FILLS, "betas"),
            """SELECT ROUND(exposure, 1) AS firm_beta_weighted_exposure, ROUND(mv, 1) AS firm_total_mv, num_accounts,
                      exposure > 10000000 AS limit_breached, CAST(k + 1 AS INTEGER) AS version,
                      CASE WHEN (exposure > 10000000) IS DISTINCT FROM COALESCE(LAG(exposure > 10000000) OVER (ORDER BY k), FALSE)
                           THEN CASE WHEN exposure > 10000000 THEN 'ABOVE' ELSE 'BELOW' END END AS crossed
               FROM (SELECT h.k, SUM(h.qty * p.price) AS mv, SUM(h.qty * p.price * b.beta) AS exposure, COUNT(DISTINCT h.account_id) AS num_accounts
                     FROM known_position h JOIN known_price p ON p.k = h.k AND p.symbol = h.symbol JOIN betas b ON b.symbol = h.symbol GROUP BY h.k)""",
            DELIVERED,
        ),
        "stream_ladder_clock": _clock(),
        "stream_progress": _with(
            ("messages",),
            """SELECT 'positions' AS query, CAST((SELECT COUNT(*) FROM messages) AS BIGINT) AS input_rows,
                      COUNT(DISTINCT (user_id, event_type)) AS state_rows
               FROM messages WHERE topic = 'fills.v1' AND NOT broken AND NOT odd_price""",
        ),
        "stream_ladder": _ladder(f"SELECT {ACTION} FROM actions"),
        "stream_ladder_expiry": _expiry(),
        "stream_ladder_combined": _ladder(f"SELECT {ACTION} FROM actions", True),
    }
