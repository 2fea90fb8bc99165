"""Enforcement ladder: warning, margin call, restriction, liquidation.

An account's standing only ever worsens, so its whole history follows from a
few first moments: the first thin cushion, the first shortfall, the first
severe stress failure, and the first shortfall more than the escalation time
after the call. Each is a MIN over (ts, event_id), combined map-side, so an
account with a third of all events still sends one row per task. Only
shortfalls are looked at a second time, and only for accounts whose last one
comes late enough to escalate; of these, accounts with very many are spread.

A state row lives for ``state_ttl_days``; an account whose last one has run
out by the time of a snapshot starts anew. `ladder_span` walks a span no
longer than that, in which a state can run out once at most: the one brought
along. `ladder` walks any history, span after span.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.columns import (
    is_warning,
    minutes_between,
    percent_text,
    stable_id,
)
from ballast.functions.skew import hot_keys, lookup_join
from ballast.params import (
    CALL_OUTSTANDING,
    DEFAULT,
    SCALE,
    STRESS_FAILED,
    TOPIC_CALLS,
    TOPIC_LIQUIDATIONS,
    TOPIC_RESTRICTIONS,
    RiskParams,
    Scale,
)
from ballast.session import work_folder

ACTIVE, WARNING, MARGIN_CALL, RESTRICTED = "ACTIVE", "WARNING", "MARGIN_CALL", "RESTRICTED"

#: What is kept of a snapshot for an action by the margin rule, and for one by the stress rule.
MARGIN_SNAPSHOT = ("ts", "event_id", "excess", "equity", "total_mv", "maintenance_req")
SNAPSHOT = (*MARGIN_SNAPSHOT, "scenario", "excess_stressed")


def _stress_failure(params: RiskParams) -> Column:
    """First severe scenario, in scenario order, that leaves the account under water."""
    failures = []
    for s in params.severe_scenarios:
        stressed = (F.col("equity") + F.col("beta_weighted_exposure") * F.lit(float(s))) - F.col("maintenance_req")
        failures.append(
            F.when(
                stressed < 0, F.struct(F.lit(float(s)).alias("scenario"), stressed.alias("excess_stressed"))
            )
        )
    return F.coalesce(*failures)


def judged(events: DataFrame, params: RiskParams = DEFAULT, stress: bool = False) -> DataFrame:
    """account_id and the columns of SNAPSHOT; scenario and excess_stressed only where a severe stress test fails."""
    failure = _stress_failure(params) if stress else F.lit(None).cast("struct<scenario:double,excess_stressed:double>")
    return events.withColumn("_failure", failure).select(
        "account_id",
        *SNAPSHOT[:6],
        F.col("_failure.scenario").alias("scenario"),
        F.col("_failure.excess_stressed").alias("excess_stressed"),
    )


def _at(moment: str) -> Column:
    return F.struct(F.col(f"{moment}.ts"), F.col(f"{moment}.event_id"))


def ladder(
    events: DataFrame,
    params: RiskParams = DEFAULT,
    stress: bool = False,
    prior: DataFrame | None = None,
    scale: Scale = SCALE,
) -> DataFrame:
    """Actions taken over margin snapshots; see `ladder_span`.

    Snapshots over more than ``state_ttl_days`` are walked in spans of that length, each reading its own part of the
    events and the actions of the span before, which are written to the shared folder: what lies further back has
    run out.
    """
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    length = timedelta(days=params.state_ttl_days)
    if first is None or last < first + length:
        return ladder_span(events, params, stress, prior, scale)
    spark, folder = events.sparkSession, work_folder(events.sparkSession, "spans")
    number = 0
    while first <= last:
        begin, end = (F.lit(t).cast(events.schema["ts"].dataType) for t in (first, first + length))
        taken = ladder_span(events.filter((F.col("ts") >= begin) & (F.col("ts") < end)), params, stress, prior, scale)
        taken.write.parquet(f"{folder}/span={number}")
        prior = latest_state(state_history(spark.read.schema(taken.schema).parquet(f"{folder}/span={number}"), params))
        first, number = first + length, number + 1
    return spark.read.schema(taken.schema).option("recursiveFileLookup", "true").parquet(folder)


def ladder_span(
    events: DataFrame,
    params: RiskParams = DEFAULT,
    stress: bool = False,
    prior: DataFrame | None = None,
    scale: Scale = SCALE,
) -> DataFrame:
    """Actions taken over margin snapshots that span at most ``state_ttl_days``.

    stress: also restrict on a severe stress failure; the margin rule of a
    snapshot comes before its stress rule.
    prior: latest state per account (account_id, status,
    margin_call_issued_at, ttl) reached before these events.
    """
    rows = judged(events, params, stress).filter(F.col("account_id").isNotNull())
    thin = is_warning(F.col("excess"), F.col("total_mv"), params)
    short = F.col("excess") < 0
    failed = F.col("scenario").isNotNull()
    rows = rows.filter(thin | short | failed)
    shortfalls = rows.filter(short).select("account_id", *MARGIN_SNAPSHOT)
    escalation = F.expr(f"INTERVAL {int(params.escalation_minutes)} MINUTES")
    hot = hot_keys(rows, ["account_id"], scale)

    kinds = {"warned": (thin, MARGIN_SNAPSHOT), "called": (short, MARGIN_SNAPSHOT), "failed": (failed, SNAPSHOT)}

    def firsts_of(among: Column) -> list[Column]:
        return [F.min(F.when(among & flag, F.struct(*kept))).alias(name) for name, (flag, kept) in kinds.items()]

    last_short = F.max(F.when(short, F.col("ts"))).alias("last_short")
    if prior is None:
        firsts = rows.groupBy("account_id").agg(
            *firsts_of(F.lit(True)),
            last_short,
            F.lit(ACTIVE).alias("status"),
            F.lit(None).cast(events.schema["ts"].dataType).alias("issued_before"),
        )
    else:
        known = prior.select("account_id", "status", F.col("margin_call_issued_at").alias("issued_before"), "ttl")
        rows = lookup_join(rows, known, "account_id", spread=["event_id"], scale=scale, hot=hot)
        alive = F.coalesce(F.col("ts") < F.col("ttl"), F.lit(False))
        rows = rows.filter(~alive | (F.col("status") != RESTRICTED))
        # a step before the state runs out renews it past the end of the span; without one the account starts anew
        called = F.col("status") == MARGIN_CALL
        step = failed | (short & F.when(called, F.col("ts") > F.col("issued_before") + escalation).otherwise(True))
        ages = rows.groupBy("account_id").agg(
            F.struct(*firsts_of(alive)).alias("on"),
            F.struct(*firsts_of(~alive)).alias("anew"),
            last_short,
            F.bool_or(alive & step).alias("renewed"),
            F.max("status").alias("status"),
            F.max("issued_before").alias("issued_before"),
        )
        earliest = lambda name: F.when(F.col("renewed"), F.least(f"on.{name}", f"anew.{name}")).otherwise(F.col(f"anew.{name}"))
        firsts = ages.select(
            "account_id",
            *[earliest(name).alias(name) for name in kinds],
            "last_short",
            F.when(F.col("renewed"), F.col("status")).otherwise(F.lit(ACTIVE)).alias("status"),
            F.when(F.col("renewed"), F.col("issued_before")).alias("issued_before"),
        )
    until_failure = lambda moment: F.col("failed").isNull() | (_at(moment) <= _at("failed"))
    uncalled = F.col("status") != MARGIN_CALL
    firsts = (
        firsts.withColumn(
            "warned",
            F.when(
                (F.col("status") == ACTIVE)
                & (F.col("called").isNull() | (_at("warned") < _at("called")))
                & until_failure("warned"),
                F.col("warned"),
            ),
        )
        .withColumn("called", F.when(uncalled & until_failure("called"), F.col("called")))
        .withColumn("issued_at", F.when(uncalled, F.col("called.ts")).otherwise(F.col("issued_before")))
        .select("account_id", "warned", "called", "failed", "issued_at", "last_short")
    )
    # second look at the shortfalls, now that the time of the call is known
    waiting = firsts.filter(F.col("last_short") > F.col("issued_at") + escalation).select(
        "account_id", "issued_at", _at("failed").alias("failed_at"), F.col("failed").isNull().alias("unfailed")
    )
    stale = (F.col("ts") > F.col("issued_at") + escalation) & (
        F.col("unfailed") | (F.struct("ts", "event_id") <= F.col("failed_at"))
    )
    restricted = (
        lookup_join(shortfalls, waiting, "account_id", spread=["event_id"], how="inner", scale=scale, hot=hot)
        .filter(stale)
        .groupBy("account_id")
        .agg(F.min(F.struct(*MARGIN_SNAPSHOT)).alias("restricted"))
    )
    walked = (
        firsts.join(restricted, "account_id", "left")
        .select("account_id", "issued_at", "warned", "called", "failed", "restricted")
        .withColumn("failed", F.when(F.col("restricted").isNull(), F.col("failed")))
    )
    return _actions(walked, params)


#: What each step means: action, trigger, topic, and the status after it.
STEPS = {
    "WARNING_ISSUED": ("WARNING", None, TOPIC_CALLS, WARNING),
    "MARGIN_CALL_ISSUED": ("MARGIN_CALL", None, TOPIC_CALLS, MARGIN_CALL),
    "RESTRICTION_APPLIED": ("CLOSE_ONLY", None, TOPIC_RESTRICTIONS, RESTRICTED),
    "LIQUIDATION_TRIGGERED": (None, "SEVERE_DEFICIENCY", TOPIC_LIQUIDATIONS, RESTRICTED),
    "STRESS_RESTRICTION": ("CLOSE_ONLY", None, TOPIC_RESTRICTIONS, RESTRICTED),
}


def _actions(walked: DataFrame, params: RiskParams) -> DataFrame:
    severe = -F.col("restricted.excess") > F.col("restricted.maintenance_req") * F.lit(params.liquidation_share)
    def in_full(at: Column) -> Column:
        none = F.lit(None).cast("double")
        parts = [*(at[c].alias(c) for c in MARGIN_SNAPSHOT), none.alias("scenario"), none.alias("excess_stressed")]
        return F.when(at.isNotNull(), F.struct(*parts))

    warned, called, restricted = (in_full(F.col(c)) for c in ("warned", "called", "restricted"))
    moments = {
        "WARNING_ISSUED": warned,
        "MARGIN_CALL_ISSUED": called,
        "RESTRICTION_APPLIED": restricted,
        "LIQUIDATION_TRIGGERED": F.when(severe, restricted),
        "STRESS_RESTRICTION": F.col("failed"),
    }
    steps = F.array(*[F.struct(F.lit(kind).alias("event_type"), at.alias("at")) for kind, at in moments.items()])
    taken = walked.select("account_id", "issued_at", F.inline(steps)).filter(F.col("at").isNotNull())
    return described(taken.select("account_id", "issued_at", "event_type", "at.*"))


def described(taken: DataFrame) -> DataFrame:
    """Actions in full from (account_id, issued_at, event_type, the columns of SNAPSHOT); batch or stream."""
    kind = F.col("event_type")
    by_stress = kind == "STRESS_RESTRICTION"
    by_margin = ~by_stress

    def meaning(place: int) -> Column:
        out = F.lit(None).cast("string")
        for name, step in STEPS.items():
            out = F.when(kind == name, F.lit(step[place]).cast("string")).otherwise(out)
        return out

    elapsed = F.when(kind == "RESTRICTION_APPLIED", minutes_between(F.col("ts"), F.col("issued_at")))
    return (
        taken.select(
            "account_id",
            "issued_at",
            "ts",
            "event_id",
            "event_type",
            meaning(0).alias("action"),
            meaning(1).alias("trigger"),
            meaning(2).alias("topic"),
            meaning(3).alias("status"),
            *[F.when(by_margin, F.col(c)).alias(c) for c in SNAPSHOT[2:6]],
            *[F.when(by_stress, F.col(c)).alias(c) for c in SNAPSHOT[6:]],
        )
        .withColumn(
            "deficiency",
            F.when(by_margin & (kind != "WARNING_ISSUED"), -F.col("excess")),
        )
        .withColumn("elapsed_minutes", elapsed)
        .withColumn(
            "reason",
            F.when(
                kind == "RESTRICTION_APPLIED",
                F.format_string(CALL_OUTSTANDING, F.col("elapsed_minutes")),
            ).when(
                by_stress,
                F.format_string(STRESS_FAILED, percent_text(F.col("scenario"))),
            ),
        )
        .withColumn(
            "margin_call_issued_at",
            F.when(kind.isin("MARGIN_CALL_ISSUED", "RESTRICTION_APPLIED", "LIQUIDATION_TRIGGERED"), F.col("issued_at")),
        )
        .withColumn("correlation_id", stable_id(F.lit("event"), "account_id", "event_id"))
        .drop("issued_at")
    )


def state_history(actions: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """State rows written by actions; a liquidation trigger leaves the state as it is."""
    return actions.filter(F.col("event_type") != "LIQUIDATION_TRIGGERED").select(
        "account_id",
        "ts",
        "status",
        "equity",
        F.col("total_mv").alias("market_value"),
        "maintenance_req",
        "excess",
        "margin_call_issued_at",
        F.col("event_type").alias("last_action"),
        F.col("scenario").alias("stress_scenario"),
        "excess_stressed",
        (F.col("ts") + F.expr(f"INTERVAL {int(params.state_ttl_days)} DAYS")).alias("ttl"),
    )


def severity(status: Column) -> Column:
    """Rank of a status on the ladder; breaks ties between rows of one instant."""
    return F.array_position(F.array(*[F.lit(s) for s in (ACTIVE, WARNING, MARGIN_CALL, RESTRICTED)]), status)


def latest_state(history: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Current state per account, leaving out rows past their time to live at ``as_of``."""
    if as_of is not None:
        history = live_state(history, as_of)
    columns = [c for c in history.columns if c != "account_id"]
    return (
        history.groupBy("account_id")
        .agg(F.max_by(F.struct(*columns), F.struct(F.col("ts"), severity(F.col("status")))).alias("s"))
        .select("account_id", "s.*")
    )


def live_state(history: DataFrame, as_of: Column) -> DataFrame:
    return history.filter(F.col("ttl") > as_of)


def with_state(events: DataFrame, latest: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Attach each account's current status, ACTIVE where none is on file."""
    known = latest.select("account_id", "status", "margin_call_issued_at", "last_action")
    return lookup_join(events, known, "account_id", spread=["event_id"], scale=scale).withColumn(
        "status", F.coalesce("status", F.lit(ACTIVE))
    )
