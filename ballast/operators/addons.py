"""House add-ons to the maintenance requirement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.functions.skew import lookup_join
from ballast.operators.positions import position_weights
from ballast.params import DEFAULT, SCALE, RiskParams, Scale


def _with_addon(positions: DataFrame, name: str, addon, params: RiskParams) -> DataFrame:
    return (
        positions.groupBy("account_id")
        .agg(F.sum("market_value").alias("total_mv"), F.sum(addon).alias(name))
        .withColumn("maintenance_req", F.col("total_mv") * F.lit(params.maintenance_rate) + F.col(name))
    )


def concentration_margin(valued: DataFrame, params: RiskParams = DEFAULT, scale: Scale = SCALE) -> DataFrame:
    """Extra margin on positions that make up too much of their account."""
    addon = F.when(
        F.col("weight") > F.lit(params.concentration_limit),
        F.col("market_value") * F.lit(params.concentration_rate),
    ).otherwise(F.lit(0.0))
    return _with_addon(position_weights(valued, scale), "concentration_addon", addon, params)


def volatility_margin(
    valued: DataFrame, latest_volatility: DataFrame, params: RiskParams = DEFAULT, scale: Scale = SCALE
) -> DataFrame:
    """Extra margin by tiers of annual volatility; unknown volatility takes the default."""
    annual = F.coalesce("volatility_annual", F.lit(params.volatility_default))
    addon = F.lit(0.0)
    for above, rate in reversed(params.volatility_tiers):
        addon = F.when(annual > F.lit(above), F.col("market_value") * F.lit(rate)).otherwise(addon)
    rated = lookup_join(
        valued, latest_volatility.select("symbol", "volatility_annual"), "symbol", spread=["account_id"], scale=scale
    )
    return _with_addon(rated, "volatility_addon", addon, params)


def low_price_margin(valued: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Low-priced securities carry their full value, all others the flat rate."""
    rate = F.when(F.col("price") < F.lit(params.low_price), F.lit(1.0)).otherwise(F.lit(params.maintenance_rate))
    return valued.groupBy("account_id").agg(
        F.sum("market_value").alias("total_mv"),
        F.sum(F.col("market_value") * rate).alias("maintenance_req"),
        F.count_if(F.col("price") < F.lit(params.low_price)).alias("low_priced"),
    )


def leverage_overlay(margin: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Extra margin where beta-weighted exposure exceeds a multiple of equity."""
    return margin.withColumn("leverage", F.try_divide("beta_weighted_exposure", "equity")).withColumn(
        "leverage_addon",
        F.when(
            F.col("leverage") > F.lit(params.leverage_limit), F.col("total_mv") * F.lit(params.leverage_rate)
        ).otherwise(F.lit(0.0)),
    )
