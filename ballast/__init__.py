"""Margin-risk analytics for brokerage accounts on Spark DataFrames and streams."""

from ballast.params import DEFAULT, SCALE, RiskParams, Scale

__all__ = ["DEFAULT", "SCALE", "RiskParams", "Scale"]
