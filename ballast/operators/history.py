"""Returns, volatility, beta and shocks from the price history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.skew import (
    CARRIED,
    carry_rows,
    hot_keys,
    lookup_join,
    segment_window,
)
from ballast.params import DAY_MOVES, DEFAULT, SCALE, RiskParams, Scale

TICK_ORDER = ("ts", "seq", "price")


def _return(window):
    before = F.lag("price", 1).over(window)
    return F.try_divide(F.col("price") - before, before)


def price_returns(
    ticks: DataFrame, order: Sequence[str] = TICK_ORDER, hot: DataFrame | None = None, scale: Scale = SCALE
) -> DataFrame:
    """Simple return of each tick over the one before it."""
    hot = hot_keys(ticks, ["symbol"], scale) if hot is None else hot
    rows = carry_rows(ticks, ["symbol"], order, 1, hot, scale)
    window = segment_window(["symbol"], [F.col(o) for o in order])
    return rows.withColumn("return", _return(window)).filter(~F.col(CARRIED)).select(*ticks.columns, "return")


def rolling_volatility(
    ticks: DataFrame,
    order: Sequence[str] = TICK_ORDER,
    hot: DataFrame | None = None,
    params: RiskParams = DEFAULT,
    scale: Scale = SCALE,
) -> DataFrame:
    """Standard deviation of the last returns of each symbol, plain and annual."""
    hot = hot_keys(ticks, ["symbol"], scale) if hot is None else hot
    n = params.volatility_rows
    rows = carry_rows(ticks, ["symbol"], order, n, hot, scale)
    window = segment_window(["symbol"], [F.col(o) for o in order])
    return (
        rows.withColumn("return", _return(window))
        .withColumn("volatility", F.stddev_samp("return").over(window.rowsBetween(1 - n, 0)))
        .filter(~F.col(CARRIED))
        .withColumn("volatility_annual", F.col("volatility") * F.sqrt(F.lit(float(params.trading_days))))
        .select(*ticks.columns, "return", "volatility", "volatility_annual")
    )


def latest_volatility(
    ticks: DataFrame, order: Sequence[str] = TICK_ORDER, params: RiskParams = DEFAULT
) -> DataFrame:
    """The newest row of ``rolling_volatility`` per symbol.

    It depends on the last n + 1 ticks alone; the rank filter keeps that many
    per symbol and task before anything is shuffled.
    """
    n = params.volatility_rows
    newest = Window.partitionBy("symbol").orderBy(*[F.col(o).desc() for o in order])
    along = Window.partitionBy("symbol").orderBy(F.col("_rank").desc())
    return (
        ticks.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= F.lit(n + 1))
        .withColumn("return", _return(along))
        .groupBy("symbol")
        .agg(F.stddev_samp("return").alias("volatility"))
        .withColumn("volatility_annual", F.col("volatility") * F.sqrt(F.lit(float(params.trading_days))))
    )


def daily_closes(ticks: DataFrame, order: Sequence[str] = TICK_ORDER) -> DataFrame:
    """The last price of each symbol and day, (symbol, ts, price), where ts is the first instant of the day."""
    day = F.date_trunc("day", "ts").cast(ticks.schema["ts"].dataType).alias("day")
    return ticks.groupBy("symbol", day).agg(F.max_by("price", F.struct(*order)).alias("price")).withColumnRenamed("day", "ts")


def estimated_beta(returns: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Beta of each symbol: covariance with the market's mean return of the day over its variance.

    ``returns`` has symbol, day, return. Both moments use n - 1.
    """
    market = returns.groupBy("day").agg(F.avg("return").alias("market_return"))
    paired = lookup_join(returns, market, "day", spread=["symbol", "return"], how="inner", scale=scale)
    return (
        paired.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.covar_samp("return", "market_return").alias("_covariance"),
            F.var_samp("market_return").alias("_variance"),
        )
        .select(
            "symbol", "observations", F.try_divide("_covariance", "_variance").alias("estimated_beta")
        )
    )


def shocked_prices(symbol_marks: DataFrame, moves: Sequence[float] = DAY_MOVES) -> DataFrame:
    """Each marked price along a path of market moves, scaled by the symbol's beta."""
    price, steps = F.col("price"), []
    for step, move in enumerate(moves):
        price = price * (F.lit(1.0) + F.col("beta") * F.lit(float(move)))
        steps.append(
            F.struct(
                F.lit(step).alias("step"), F.lit(float(move)).alias("market_move"), price.alias("shocked_price")
            )
        )
    return symbol_marks.select("symbol", "price", "beta", F.inline(F.array(*steps)))
