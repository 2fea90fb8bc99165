"""Rates, thresholds and scenario grids, and the knobs that govern scale."""

from __future__ import annotations

from dataclasses import dataclass

# Index moves of the beta-weighted stress test.
INDEX_SCENARIOS = (-0.08, -0.06, -0.04, -0.02, 0.0, 0.02, 0.04, 0.06)

# Price moves of the portfolio-margin grid.
GRID_SCENARIOS = (-0.15, -0.10, -0.05, -0.03, -0.01, 0.01, 0.03, 0.05, 0.10, 0.15)

# Index moves of one trading day, in order.
DAY_MOVES = (0.0, 0.01, -0.005, -0.02, -0.03, -0.01)

# Scenario tags and topic names on the wire.
INDEX_TAG = "SPY_BETA_WEIGHTED"
GRID_TAG = "TIMS_PORTFOLIO"
TOPIC_FILLS = "fills.v1"
TOPIC_PRICES = "prices.v1"
TOPIC_BETAS = "betas.v1"
TOPIC_MARGIN = "margin.calc.v1"
TOPIC_STRESS = "stress.beta_spy.v1"
TOPIC_CALLS = "margin.calls.v1"
TOPIC_RESTRICTIONS = "restrictions.v1"
TOPIC_LIQUIDATIONS = "liquidations.v1"
TOPIC_AUDIT = "audit.v1"
TOPIC_VOLATILITY = "volatility.v1"
TOPIC_FIRM = "firm.risk.v1"
TOPIC_ORDERS = "liquidation.orders.v1"

# Reasons on the wire.
CALL_OUTSTANDING = "Margin call outstanding for %.0f minutes"
STRESS_FAILED = "Underwater in SPY %s stress scenario"

TOPICS = (
    TOPIC_FILLS,
    TOPIC_PRICES,
    TOPIC_BETAS,
    TOPIC_MARGIN,
    TOPIC_STRESS,
    TOPIC_CALLS,
    TOPIC_RESTRICTIONS,
    TOPIC_LIQUIDATIONS,
    TOPIC_AUDIT,
)


@dataclass(frozen=True)
class RiskParams:
    """House and regulatory constants; every operator takes one of these."""

    maintenance_rate: float = 0.25
    house_rate: float = 0.30
    initial_rate: float = 0.50
    cash_fraction: float = 0.10
    index_scenarios: tuple[float, ...] = INDEX_SCENARIOS
    grid_scenarios: tuple[float, ...] = GRID_SCENARIOS
    grid_multiplier: float = 1.0
    default_price: float = 0.0
    default_beta: float = 1.0
    warning_pct: float = 0.05
    escalation_minutes: int = 30
    severe_move: float = 0.06
    liquidation_share: float = 0.5
    liquidation_buffer: float = 1.10
    state_ttl_days: int = 30
    audit_retention_days: int = 90
    concentration_limit: float = 0.30
    concentration_rate: float = 0.10
    volatility_default: float = 0.20
    # (annual volatility above, extra rate), highest first
    volatility_tiers: tuple[tuple[float, float], ...] = ((0.60, 0.10), (0.40, 0.05))
    volatility_rows: int = 31
    trading_days: int = 252
    leverage_limit: float = 2.0
    leverage_rate: float = 0.05
    low_price: float = 5.0
    firm_limit: float = 10_000_000.0
    watermark: str = "5 seconds"

    @property
    def severe_scenarios(self) -> tuple[float, ...]:
        return tuple(s for s in self.index_scenarios if abs(s) >= self.severe_move)


@dataclass(frozen=True)
class Scale:
    """How work on one key is split.

    hot_rows: a key with more rows than this is cut into ordered segments. At
        most rows / hot_rows keys can pass, which bounds the broadcast list.
    samples: rows sampled for each segment to find where it ends.
    salts: pieces a key is spread over when a lookup side is too big to
        broadcast.
    page_rows: most rows gathered into one array.
    """

    hot_rows: int = 1_000_000
    samples: int = 16
    salts: int = 16
    page_rows: int = 500


DEFAULT = RiskParams()
SCALE = Scale()
