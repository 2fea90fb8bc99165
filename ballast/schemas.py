"""Declared schemas of the event relations (no inference anywhere). Field names and types of the wire."""

from __future__ import annotations

from ballast import params as p

FILLS = "account_id STRING, symbol STRING, qty INT, price DOUBLE, timestamp BIGINT, fill_id STRING"
PRICES = "symbol STRING, price DOUBLE, timestamp BIGINT"
BETAS = "symbol STRING, beta DOUBLE, timestamp BIGINT"
MARGIN = (
    "account_id STRING, total_mv DOUBLE, beta_weighted_exposure DOUBLE, cash DOUBLE, equity DOUBLE, "
    "maintenance_req DOUBLE, excess DOUBLE, excess_pct DOUBLE, calc_timestamp BIGINT"
)
STRESS = (
    "account_id STRING, scenario DOUBLE, scenario_type STRING, delta_pnl DOUBLE, equity_stressed DOUBLE, "
    "excess_stressed DOUBLE, underwater BOOLEAN, calc_timestamp BIGINT"
)
CALLS = (
    "account_id STRING, action STRING, deficiency DOUBLE, excess DOUBLE, equity DOUBLE, "
    "maintenance_req DOUBLE, timestamp TIMESTAMP, correlation_id STRING"
)
RESTRICTIONS = (
    "account_id STRING, action STRING, reason STRING, deficiency DOUBLE, excess_stressed DOUBLE, "
    "scenario DOUBLE, timestamp TIMESTAMP, correlation_id STRING"
)
LIQUIDATIONS = (
    "account_id STRING, trigger STRING, deficiency DOUBLE, timestamp TIMESTAMP, correlation_id STRING"
)
AUDIT = (
    "event_id STRING, event_type STRING, account_id STRING, timestamp TIMESTAMP_NTZ, "
    "details STRUCT<deficiency: DOUBLE, excess: DOUBLE, excess_pct: DOUBLE, equity: DOUBLE, maintenance_req: DOUBLE, "
    "elapsed_minutes: DOUBLE, scenario: DOUBLE, excess_stressed: DOUBLE, action: STRING, trigger: STRING, reason: STRING>, "
    "correlation_id STRING, causation_id STRING"
)
AUDIT_PARTITIONS = "year INT, month INT, day INT, hour INT"
HISTORY_CSV = "timestamp TIMESTAMP_NTZ, symbol STRING, price DOUBLE"

BY_TOPIC = {
    p.TOPIC_FILLS: FILLS,
    p.TOPIC_PRICES: PRICES,
    p.TOPIC_BETAS: BETAS,
    p.TOPIC_MARGIN: MARGIN,
    p.TOPIC_STRESS: STRESS,
    p.TOPIC_CALLS: CALLS,
    p.TOPIC_RESTRICTIONS: RESTRICTIONS,
    p.TOPIC_LIQUIDATIONS: LIQUIDATIONS,
    p.TOPIC_AUDIT: AUDIT,
}
