"""Firm-wide risk and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.operators.stress import across
from ballast.params import DEFAULT, GRID_TAG, INDEX_TAG, RiskParams


def firm_risk(margin: DataFrame) -> DataFrame:
    return margin.agg(
        F.sum("beta_weighted_exposure").alias("firm_beta_weighted_exposure"),
        F.sum("total_mv").alias("firm_total_mv"),
        F.count("account_id").alias("num_accounts"),
    )


def firm_stress(firm: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    return (
        across(firm, params.index_scenarios, INDEX_TAG)
        .withColumn("firm_delta_pnl", F.col("firm_beta_weighted_exposure") * F.col("scenario"))
        .withColumn("limit_breached", F.col("firm_beta_weighted_exposure") > F.lit(params.firm_limit))
    )


def firm_limit_alert(firm: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    return firm.filter(F.col("firm_beta_weighted_exposure") > F.lit(params.firm_limit)).withColumn(
        "firm_limit", F.lit(params.firm_limit)
    )


def margin_distribution(margin: DataFrame, width: float = 0.05) -> DataFrame:
    """Accounts per band of excess over market value."""
    return (
        margin.withColumn("band", F.floor(F.try_divide("excess_pct", F.lit(width))).cast("bigint"))
        .groupBy("band")
        .agg(F.count(F.lit(1)).alias("accounts"), F.sum("total_mv").alias("total_mv"))
    )


def stress_pass_rate(stress: DataFrame) -> DataFrame:
    return stress.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.count_if("underwater").alias("underwater"),
        F.avg(F.col("underwater").cast("int")).alias("fail_rate"),
    )


def scenario_table(totals: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Every scenario of both kinds with the P&L it means for all accounts together."""
    exposures = totals.agg(
        F.sum("beta_weighted_exposure").alias("exposure"), F.sum("total_mv").alias("value")
    )
    kinds = F.array(
        *[
            F.struct(F.lit(float(s)).alias("scenario"), F.lit(tag).alias("scenario_type"))
            for tag, grid in ((INDEX_TAG, params.index_scenarios), (GRID_TAG, params.grid_scenarios))
            for s in grid
        ]
    )
    base = F.when(F.col("scenario_type") == INDEX_TAG, F.col("exposure")).otherwise(F.col("value"))
    return exposures.select("exposure", "value", F.inline(kinds)).select(
        "scenario", "scenario_type", (base * F.col("scenario")).alias("total_pnl")
    )
