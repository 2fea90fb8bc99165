"""Net positions, latest marks, valuation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.skew import lookup_join
from ballast.params import DEFAULT, SCALE, RiskParams, Scale

TICK_ORDER = ("ts", "seq", "price")


def net_positions(fills: DataFrame) -> DataFrame:
    """Net quantity and time of the last fill per account and symbol."""
    return fills.groupBy("account_id", "symbol").agg(
        F.sum("qty").alias("qty"), F.max("ts").alias("last_updated")
    )


def open_positions(positions: DataFrame) -> DataFrame:
    return positions.filter(F.col("qty") != 0)


def latest_value(ticks: DataFrame, value: str, order: Sequence[str] = TICK_ORDER) -> DataFrame:
    """Newest ``value`` per symbol by event time, partially aggregated before the shuffle."""
    return ticks.groupBy("symbol").agg(F.max_by(value, F.struct(*order)).alias(value))


def latest_value_ranked(ticks: DataFrame, value: str, order: Sequence[str] = TICK_ORDER) -> DataFrame:
    """The same by ROW_NUMBER = 1; Spark keeps one row per symbol and task before the shuffle."""
    newest = Window.partitionBy("symbol").orderBy(*[F.col(o).desc() for o in order])
    return (
        ticks.withColumn("rn", F.row_number().over(newest))
        .filter(F.col("rn") == 1)
        .select("symbol", value, "ts")
    )


def marks(latest_prices: DataFrame, latest_betas: DataFrame) -> DataFrame:
    """Price and beta side by side, so positions meet both in one join."""
    return latest_prices.join(latest_betas, "symbol", "full").select("symbol", "price", "beta")


def value_positions(
    positions: DataFrame,
    symbol_marks: DataFrame,
    missing: str = "zero",
    params: RiskParams = DEFAULT,
    scale: Scale = SCALE,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Market value and beta-weighted value of every position.

    missing: "zero" values an unpriced position at the default price and an
    unrated one at the default beta; "null" leaves both unknown, which sums
    skip; "fill_price" falls back to the position's own ``fill_price``.
    hot: symbols with very many positions, see `lookup_join`.
    """
    joined = lookup_join(positions, symbol_marks, "symbol", spread=["account_id"], scale=scale, hot=hot)
    price, beta = {
        "zero": (f"coalesce(price, {params.default_price!r}D)", f"coalesce(beta, {params.default_beta!r}D)"),
        "null": ("price", "beta"),
        "fill_price": ("coalesce(price, fill_price)", f"coalesce(beta, {params.default_beta!r}D)"),
    }[missing]
    kept = [c for c in positions.columns if c not in ("account_id", "symbol", "qty")]
    return joined.selectExpr("account_id", "symbol", "qty", *kept, f"{price} AS price", f"{beta} AS beta").selectExpr(
        "*", "qty * price AS market_value", "qty * price * beta AS beta_weighted_value"
    )


def position_weights(valued: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Share of each position in its account's market value.

    Totals are aggregated and joined back rather than windowed: a window would
    hold an account's positions in one task.
    """
    totals = valued.groupBy("account_id").agg(F.sum("market_value").alias("total_mv"))
    return lookup_join(valued, totals, "account_id", spread=["symbol"], scale=scale).withColumn(
        "weight", F.try_divide("market_value", "total_mv")
    )
