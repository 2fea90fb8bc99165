"""Index stress, price-grid P&L, portfolio margin.

A scenario set is a handful of literals, so rows meet it by ``explode`` of a
constant array: no join, no shuffle, and the partitioning by account survives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.params import DEFAULT, GRID_TAG, INDEX_TAG, RiskParams


def across(df: DataFrame, scenarios: tuple[float, ...], tag: str) -> DataFrame:
    """One row per input row and scenario."""
    return df.withColumn("scenario", F.explode(F.array(*[F.lit(float(s)) for s in scenarios]))).withColumn(
        "scenario_type", F.lit(tag)
    )


def stress_columns(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("delta_pnl", F.col("beta_weighted_exposure") * F.col("scenario"))
        .withColumn("equity_stressed", F.col("equity") + F.col("delta_pnl"))
        .withColumn("excess_stressed", F.col("equity_stressed") - F.col("maintenance_req"))
        .withColumn("underwater", F.col("excess_stressed") < 0)
    )


def beta_stress(margin: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Accounts under each index move, by their beta-weighted exposure."""
    return stress_columns(across(margin, params.index_scenarios, INDEX_TAG))


def severe_underwater(stress: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    return stress.filter(F.col("underwater") & (F.abs("scenario") >= F.lit(params.severe_move)))


def grid_pnl(totals: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Account P&L under each price move, from account totals.

    The P&L of a share is linear in the move, so the sum over positions is
    taken first and the grid applied to one row per account.
    """
    return across(totals.select("account_id", "total_mv"), params.grid_scenarios, GRID_TAG).select(
        "account_id",
        (F.col("total_mv") * F.col("scenario")).alias("portfolio_pnl"),
        "scenario",
        "scenario_type",
    )


def grid_pnl_by_position(valued: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """The same position by position, for payoffs that are not linear in the move.

    An account's sums under all moves stand side by side, so neither rows nor groups are multiplied before they are added up.
    """
    moves = list(params.grid_scenarios)
    sums = [F.sum(F.col("market_value") * F.lit(float(s))).alias(f"_pnl_{k}") for k, s in enumerate(moves)]
    outcomes = F.map_from_arrays(F.array(*[F.lit(float(s)) for s in moves]), F.array(*[f"_pnl_{k}" for k in range(len(moves))]))
    totals = valued.groupBy("account_id").agg(*sums).select("account_id", outcomes.alias("_pnl"))
    return across(totals, params.grid_scenarios, GRID_TAG).select(
        "account_id", F.element_at("_pnl", F.col("scenario")).alias("portfolio_pnl"), "scenario", "scenario_type"
    )


def worst_case(totals: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Worst grid P&L, the move that causes it, and the requirement it implies."""
    grid = F.array(*[F.lit(float(s)) for s in params.grid_scenarios])
    outcomes = F.transform(
        grid, lambda s: F.struct((F.col("total_mv") * s).alias("pnl"), s.alias("scenario"))
    )
    return (
        totals.withColumn("_worst", F.array_min(outcomes))
        .withColumn("worst_case_loss", F.col("_worst.pnl"))
        .withColumn("worst_scenario", F.col("_worst.scenario"))
        .withColumn("portfolio_margin_req", F.abs("worst_case_loss") * F.lit(params.grid_multiplier))
        .drop("_worst")
    )


def worst_of_grid(grid: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """``worst_case`` for a grid already computed row by row."""
    return (
        grid.groupBy("account_id")
        .agg(F.min(F.struct("portfolio_pnl", "scenario")).alias("_worst"))
        .select(
            "account_id",
            F.col("_worst.portfolio_pnl").alias("worst_case_loss"),
            F.col("_worst.scenario").alias("worst_scenario"),
            (F.abs("_worst.portfolio_pnl") * F.lit(params.grid_multiplier)).alias("portfolio_margin_req"),
        )
    )


def compare_methods(margin: DataFrame, portfolio: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Flat-rate against portfolio requirement; the cheaper one names the method."""
    return (
        margin.select("account_id", "total_mv")
        .withColumn("reg_t_margin", F.col("total_mv") * F.lit(params.maintenance_rate))
        .join(portfolio.select("account_id", "portfolio_margin_req"), "account_id", "left")
        .withColumn(
            "margin_method",
            F.when(F.col("portfolio_margin_req") < F.col("reg_t_margin"), "PORTFOLIO").otherwise("REG_T"),
        )
        .withColumn("margin_savings", F.col("reg_t_margin") - F.col("portfolio_margin_req"))
    )


def all_scenarios(stress: DataFrame, grid: DataFrame) -> DataFrame:
    """Index and grid results in one relation, columns of the other kind NULL."""
    return stress.select("account_id", "scenario", "scenario_type", "delta_pnl", "excess_stressed").unionByName(
        grid, allowMissingColumns=True
    )
