"""Feeds made from the star-schema tables for the registered queries: messages, gaps, repeats, late deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.columns import stable_id
from ballast.params import TOPIC_BETAS, TOPIC_FILLS, TOPIC_MARGIN, TOPIC_PRICES


def with_gaps(marks: DataFrame, every: int) -> DataFrame:
    """Fixture for the queries about missing marks: symbols divisible by ``every`` have none."""
    return marks.filter(F.col("symbol") % every != 0)


def spread_out(snapshots: DataFrame) -> DataFrame:
    """Fixture: the month of snapshots over four, so that states run out between an account's events."""
    return snapshots.withColumn("ts", F.expr("ts + make_dt_interval(CAST(event_id % 5 * 20 AS INT))"))


def fill_id() -> Column:
    """Id of a line item, from all that tells it from others. Never null, and said to be so: a test for null would make it twice."""
    made = stable_id(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        *[
            F.expr(f"CAST(CAST(floor({c} * 100 + 0.5D) AS BIGINT) AS STRING)")
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ],
        "l_returnflag",
        "l_linestatus",
        F.expr("CAST(CAST(l_shipdate AS DATE) AS STRING)"),
    )
    return F.coalesce(made, F.lit(""))


def deliveries(rows: DataFrame, number: Column, at: Column, part: Column, later: str) -> DataFrame:
    """Rows as they are delivered: `arrived`, and `slice`, the part of the feed in which they come.

    Most come at once, in the `part` of their time. Every third of these comes again ten minutes later, and once more a
    part later. Every seventh row comes only a part later, and again a part after that. `later` is the time between parts.
    """

    def way(when: Column, shift: int, after: str) -> Column:
        arrived = at + F.expr(f"INTERVAL {after}")
        return F.when(when, F.struct((part + shift).cast("int").alias("slice"), arrived.alias("arrived")))

    late, again = number % 7 == 0, number % 3 == 0
    days, unit = later.split()
    ways = F.array(
        way(~late, 0, "0 MINUTES"),
        way(~late & again, 0, "10 MINUTES"),
        way(~late & again, 1, later),
        way(late, 1, later),
        way(late, 2, f"{2 * int(days)} {unit}"),
    )
    return rows.withColumn("_way", F.explode(F.array_compact(ways))).select(*rows.columns, "_way.*")


def replay_messages(events: DataFrame) -> DataFrame:
    """Wire messages made from the event table, a few of them unusable.

    Ten event ids in turn: five fills, three prices, one beta, one of a topic
    without handler, without topic or of the margin topic (in thirds; the last
    lacks its closing brace). Every 50th lacks its closing brace; every 70th has
    text where a number belongs: shifted by 6 in a price, by 3 in a fill's
    price, which a fill can do without.
    """
    lane = F.col("event_id") % F.lit(10)
    third = F.floor(F.col("event_id") / F.lit(10)) % 3
    topic = (
        F.when(lane < 5, TOPIC_FILLS)
        .when(lane < 8, TOPIC_PRICES)
        .when(lane < 9, TOPIC_BETAS)
        .when(third == 0, "orders.v1")
        .when(third == 1, TOPIC_MARGIN)
    )
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    number = F.get_json_object("props", "$.k").cast("int")
    account, symbol = F.col("user_id").cast("string"), F.col("event_type")
    body = (
        F.when(
            F.col("event_id") % F.lit(70) == 3,
            F.to_json(
                F.struct(
                    account.alias("account_id"),
                    symbol.alias("symbol"),
                    number.alias("qty"),
                    F.lit("n/a").alias("price"),
                    ms.alias("timestamp"),
                    F.col("event_id").cast("string").alias("fill_id"),
                )
            ),
        )
        .when(
            lane < 5,
            F.to_json(
                F.struct(
                    account.alias("account_id"),
                    symbol.alias("symbol"),
                    number.alias("qty"),
                    F.col("value").alias("price"),
                    ms.alias("timestamp"),
                    F.col("event_id").cast("string").alias("fill_id"),
                )
            ),
        )
        .when(
            (lane < 8) & (F.col("event_id") % F.lit(70) == 6),
            F.to_json(F.struct(symbol.alias("symbol"), F.lit("n/a").alias("price"), ms.alias("timestamp"))),
        )
        .when(
            lane < 8,
            F.to_json(F.struct(symbol.alias("symbol"), F.col("value").alias("price"), ms.alias("timestamp"))),
        )
        .otherwise(
            F.to_json(
                F.struct(
                    symbol.alias("symbol"),
                    (number.cast("double") / F.lit(50)).alias("beta"),
                    ms.alias("timestamp"),
                )
            )
        )
    )
    cut = (F.col("event_id") % F.lit(50) == 0) | ((lane == 9) & (third == 1))
    value = F.when(cut, F.expr("left(body, length(body) - 1)")).otherwise(F.col("body"))
    return (
        events.withColumn("body", body)
        .withColumn("topic", topic)
        .select(
            "topic",
            F.when(lane < 5, account).otherwise(symbol).alias("key"),
            value.alias("value"),
            F.col("event_id").alias("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )
    )
