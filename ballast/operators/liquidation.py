"""Which positions a deficient account has to sell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.skew import CARRIED, carry_total, lookup_join, segment_window
from ballast.params import DEFAULT, SCALE, RiskParams, Scale


def liquidation_selection(
    valued: DataFrame, margin: DataFrame, params: RiskParams = DEFAULT, scale: Scale = SCALE
) -> DataFrame:
    """Whole long positions, highest beta first, until the buffered deficiency is covered.

    Ties in beta go by symbol. A short position is not sold: it would lower
    the proceeds. ``margin`` counts the positions of each account, which tells
    the accounts to split.
    """
    owed = margin.filter(F.col("excess") < 0).select(
        "account_id",
        (-F.col("excess")).alias("deficiency"),
        (-F.col("excess") * F.lit(params.liquidation_buffer)).alias("target"),
        "positions",
    )
    longs = valued.filter(F.col("qty") > 0).select(
        "account_id", "symbol", "qty", "beta", F.col("market_value").alias("estimated_proceeds")
    )
    candidates = lookup_join(longs, owed, "account_id", spread=["symbol"], how="inner", scale=scale).withColumn(
        "line", F.lit(1)
    )
    hot = owed.filter(F.col("positions") > F.lit(scale.hot_rows)).select("account_id")
    candidates = candidates.withColumn("_falling", -F.col("beta"))
    rows = carry_total(candidates, ["account_id"], ["_falling", "symbol"], ["estimated_proceeds", "line"], hot, scale)
    before = segment_window(["account_id"], [F.col("beta").desc(), F.col("symbol")]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        rows.withColumn("proceeds_before", F.coalesce(F.sum("estimated_proceeds").over(before), F.lit(0.0)))
        .withColumn("lines_before", F.coalesce(F.sum("line").over(before), F.lit(0)))
        .filter(~F.col(CARRIED) & (F.col("proceeds_before") < F.col("target")))
        .select(
            "account_id",
            "symbol",
            "qty",
            "beta",
            "estimated_proceeds",
            "proceeds_before",
            "lines_before",
            "deficiency",
            "target",
        )
    )


def liquidation_orders(selection: DataFrame, scale: Scale = SCALE, at: Column | None = None) -> DataFrame:
    """Order messages: the lines of an account in pages of bounded length; ``pages`` tells how many there are.

    ``at`` is the time on the orders, by default now.
    """
    line = F.struct("lines_before", "symbol", "qty", "estimated_proceeds")
    # the last page of an account, found by a partial aggregate beside its lines
    last = selection.groupBy("account_id").agg((F.floor(F.max("lines_before") / F.lit(scale.page_rows)) + 1).cast("int").alias("_pages"))
    return (
        lookup_join(selection, last, "account_id", spread=["symbol"], how="inner", scale=scale)
        .withColumn("page", F.floor(F.col("lines_before") / F.lit(scale.page_rows)).cast("int"))
        .groupBy("account_id", "page")
        .agg(
            F.array_sort(F.collect_list(line)).alias("_lines"),
            F.max("deficiency").alias("deficiency"),
            F.max("_pages").alias("pages"),
        )
        .select(
            "account_id",
            "page",
            "pages",
            F.transform(
                "_lines",
                lambda x: F.struct(
                    x["symbol"].alias("symbol"),
                    x["qty"].alias("qty"),
                    x["estimated_proceeds"].alias("estimated_proceeds"),
                ),
            ).alias("positions"),
            F.lit("MARGIN_DEFICIENCY").alias("reason"),
            "deficiency",
            (F.current_timestamp() if at is None else at).alias("timestamp"),
        )
    )
