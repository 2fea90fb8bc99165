"""Audit trail: events, queries over it, tracing a call, latency, text for people."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.columns import dollars_text, guarded_ratio, hour_parts, micros, stable_id
from ballast.functions.skew import lookup_join
from ballast.operators.asof import as_of
from ballast.operators.ladder import severity
from ballast.params import DEFAULT, SCALE, TOPIC_CALLS, RiskParams, Scale


def audit_events(actions: DataFrame) -> DataFrame:
    """One audit row per action, tied to its control event by the correlation id and to its snapshot by the causation id.

    The details are those that belong to the kind of action; the others are null.
    """
    kind = F.col("event_type")
    warned, restricted = kind == "WARNING_ISSUED", kind.isin("RESTRICTION_APPLIED", "STRESS_RESTRICTION")
    on_call = F.col("topic") == TOPIC_CALLS
    why = F.when(kind == "RESTRICTION_APPLIED", "Margin call escalation").when(
        kind == "STRESS_RESTRICTION", "Stress test failure"
    )
    return actions.select(
        stable_id(F.lit("audit"), "event_type", "account_id", "event_id").alias("event_id"),
        "event_type",
        "account_id",
        F.col("ts").alias("timestamp"),
        F.struct(
            "deficiency",
            F.when(on_call, F.col("excess")).alias("excess"),
            F.when(warned, guarded_ratio(F.col("excess"), F.col("total_mv"))).alias("excess_pct"),
            F.when(on_call, F.col("equity")).alias("equity"),
            F.when(on_call, F.col("maintenance_req")).alias("maintenance_req"),
            "elapsed_minutes",
            "scenario",
            "excess_stressed",
            F.when(restricted, F.col("action")).alias("action"),
            "trigger",
            why.alias("reason"),
        ).alias("details"),
        "correlation_id",
        F.col("event_id").cast("string").alias("causation_id"),
    )


def with_hours(audit: DataFrame) -> DataFrame:
    for name, part in hour_parts(F.col("timestamp")).items():
        audit = audit.withColumn(name, part)
    return audit


def control_events(actions: DataFrame) -> DataFrame:
    """Rows of the three control topics in one frame; ``topic`` routes them."""
    return actions.select(
        "topic",
        "account_id",
        "action",
        "trigger",
        "reason",
        "deficiency",
        F.when(F.col("topic") == TOPIC_CALLS, F.col("excess")).alias("excess"),
        F.when(F.col("topic") == TOPIC_CALLS, F.col("equity")).alias("equity"),
        F.when(F.col("topic") == TOPIC_CALLS, F.col("maintenance_req")).alias("maintenance_req"),
        "scenario",
        "excess_stressed",
        F.col("ts").alias("timestamp"),
        "correlation_id",
    )


def state_rows_per_account(history: DataFrame, rows: int = 10) -> DataFrame:
    """The newest ``rows`` state rows of every account."""
    newest = Window.partitionBy("account_id").orderBy(F.col("ts").desc(), severity(F.col("status")).desc())
    return history.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= F.lit(rows))


def counts_by_type(audit: DataFrame) -> DataFrame:
    return audit.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).orderBy(F.desc("events"), "event_type")


def by_account_and_type(audit: DataFrame, account_id, event_type: str) -> DataFrame:
    return audit.filter((F.col("account_id") == F.lit(account_id)) & (F.col("event_type") == event_type)).orderBy(
        F.desc("timestamp")
    )


def by_correlation(audit: DataFrame, correlation_id) -> DataFrame:
    return audit.filter(F.col("correlation_id") == F.lit(correlation_id)).orderBy("timestamp")


def accounts_with(audit: DataFrame, event_type: str) -> DataFrame:
    return audit.filter(F.col("event_type") == event_type).select("account_id").distinct()


def retained(audit: DataFrame, now, params: RiskParams = DEFAULT) -> DataFrame:
    return audit.filter(
        F.col("timestamp") > now - F.expr(f"INTERVAL {int(params.audit_retention_days)} DAYS")
    )


def call_notifications(actions: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """Text to send for every margin call."""
    return actions.filter(F.col("event_type") == "MARGIN_CALL_ISSUED").select(
        "account_id",
        "ts",
        F.format_string(
            "Margin call on account %s: deficiency %s. Deposit funds or reduce positions within "
            f"{int(params.escalation_minutes)} minutes, or the account becomes close-only.",
            F.col("account_id").cast("string"),
            dollars_text(F.col("deficiency")),
        ).alias("message"),
    )


def last_fill_before(calls: DataFrame, fills: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Per call (one per account) the last fill at or before it, with the opening fill of that position.

    Fills collapse to one row per position, then per account, each time before
    the shuffle.
    """
    asked = calls.select("account_id", F.col("ts").alias("call_ts"))
    return (
        lookup_join(fills, asked, "account_id", spread=["symbol", "ts"], how="inner", scale=scale)
        .filter(F.col("ts") <= F.col("call_ts"))
        .groupBy("account_id", "symbol")
        .agg(F.min("ts").alias("opening_fill_ts"), F.max(F.struct("ts", "seq")).alias("_last"))
        .groupBy("account_id")
        .agg(
            F.max_by(F.struct("symbol", F.col("_last.ts").alias("fill_ts"), "opening_fill_ts"), "_last").alias("f"),
        )
        .select("account_id", "f.*")
    )


def trace_call(
    actions: DataFrame,
    margin_rows: DataFrame,
    prices: DataFrame,
    fills: DataFrame,
    hot: DataFrame | None = None,
    scale: Scale = SCALE,
) -> DataFrame:
    """From each margin call back to its margin row, last fill, price in force and opening fill.

    The correlation id is made of account and event, so these join the margin
    row without hashing every snapshot.
    """
    calls = actions.filter(F.col("event_type") == "MARGIN_CALL_ISSUED")
    source = margin_rows.select("account_id", "event_id", F.col("total_mv").alias("margin_mv"))
    traced = (
        calls.select("account_id", "event_id", "ts", "correlation_id", "deficiency")
        .join(source, ["account_id", "event_id"])
        .withColumnRenamed("event_id", "margin_event_id")
        .join(last_fill_before(calls, fills, scale), "account_id", "left")
    )
    return as_of(traced, prices, "price", "price_in_force", hot=hot, scale=scale)


def end_to_end_latency(actions: DataFrame, fills: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Seconds from an account's last fill to the call that followed it."""
    calls = actions.filter(F.col("event_type") == "MARGIN_CALL_ISSUED")
    return (
        calls.select("account_id", "ts")
        .join(last_fill_before(calls, fills, scale), "account_id")
        .withColumn("latency_seconds", (micros(F.col("ts")) - micros(F.col("fill_ts"))) / F.lit(1_000_000.0))
    )
