"""Account margin: totals, equity, requirement, excess."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.functions.columns import deficiency, standing
from ballast.params import DEFAULT, RiskParams


def account_totals(valued: DataFrame) -> DataFrame:
    return valued.groupBy("account_id").agg(
        F.sum("market_value").alias("total_mv"),
        F.sum("beta_weighted_value").alias("beta_weighted_exposure"),
        F.count(F.lit(1)).alias("positions"),
    )


def margin_columns(
    totals: DataFrame, params: RiskParams = DEFAULT, rate: float | None = None, gross: bool = False, as_of=None
) -> DataFrame:
    """Equity, requirement and excess of accounts that already carry ``cash``.

    gross: take the requirement on the absolute market value, so that a
    net-short account has a positive one.
    as_of: stamps ``calc_timestamp`` (a column, or None to leave it out).
    """
    base = "abs(total_mv)" if gross else "total_mv"
    share = params.maintenance_rate if rate is None else rate
    out = totals.selectExpr("*", "cash + total_mv AS equity", f"{base} * {share!r}D AS maintenance_req").selectExpr(
        "*",
        "equity - maintenance_req AS excess",
        "try_divide(equity - maintenance_req, total_mv) AS excess_pct",
    )
    return out if as_of is None else out.withColumn("calc_timestamp", as_of)


def account_margin(valued: DataFrame, params: RiskParams = DEFAULT, **options) -> DataFrame:
    """Margin with cash taken as a fixed share of market value."""
    totals = account_totals(valued).withColumn("cash", F.col("total_mv") * F.lit(params.cash_fraction))
    return margin_columns(totals, params, **options)


def account_margin_cash(valued: DataFrame, cash: DataFrame, params: RiskParams = DEFAULT, **options) -> DataFrame:
    """Margin with cash taken from the accounts' balances (0 when unknown)."""
    totals = (
        account_totals(valued)
        .join(cash.select("account_id", "cash"), "account_id", "left")
        .withColumn("cash", F.coalesce("cash", F.lit(0.0)))
    )
    return margin_columns(totals, params, **options)


def with_deficiency(margin: DataFrame) -> DataFrame:
    return margin.withColumn("deficiency", deficiency(F.col("excess")))


def with_standing(margin: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    return margin.withColumn("standing", standing(F.col("excess"), F.col("total_mv"), params))


def initial_margin(fills: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Deposit required on each account's purchases."""
    bought = F.when(F.col("qty") > 0, F.col("qty") * F.col("price")).otherwise(F.lit(0.0))
    return (
        fills.groupBy("account_id")
        .agg(F.sum(bought).alias("purchases"))
        .withColumn("initial_margin", F.col("purchases") * F.lit(params.initial_rate))
    )


def market_leverage(margin: DataFrame) -> DataFrame:
    """Market risk carried per dollar of market value."""
    return margin.withColumn("market_leverage", F.try_divide("beta_weighted_exposure", "total_mv"))
