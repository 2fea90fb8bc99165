"""The enforcement ladder as a keyed state processor.

An account's standing is one row of state, kept with others of its bucket (`blocks`). Snapshots move it as they come, in order of time within a micro-batch,
and with `clock` so does time itself: a margin call sets an event-time timer, and when the watermark passes it the account
is restricted although no row came, unless its last snapshot had no shortfall any more.

A micro-batch is bounded by the source's options (`maxFilesPerTrigger`, `maxOffsetsPerTrigger`), so the rows of one bucket
in it fit one task; without `clock` only those that can move the ladder get there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ballast.functions.columns import is_warning
from ballast.operators.ladder import ACTIVE, MARGIN_CALL, RESTRICTED, SNAPSHOT, WARNING, described, judged
from ballast.params import DEFAULT, RiskParams
from ballast.streaming.blocks import BUCKET, BUCKETS, Blocks, bucket_of, joined

MINUTE, DAY = 60_000_000, 86_400_000_000
#: Standing of an account: times in microseconds; the fields of `last` are those of the newest snapshot of a called account.
STATE = "status STRING, issued BIGINT, ttl BIGINT, ts BIGINT, event_id BIGINT, excess DOUBLE, equity DOUBLE, total_mv DOUBLE, maintenance_req DOUBLE"
MOVES = "account_id STRING, issued_at BIGINT, event_type STRING, ts BIGINT, event_id BIGINT, excess DOUBLE, equity DOUBLE, total_mv DOUBLE, maintenance_req DOUBLE, scenario DOUBLE, excess_stressed DOUBLE"
COLUMNS = [c.split()[0] for c in MOVES.split(", ")]
KINDS = {"STRING": pa.string(), "BIGINT": pa.int64(), "DOUBLE": pa.float64()}
BLOCK = pa.schema([(name, KINDS[kind]) for name, kind in (c.split() for c in f"account_id STRING, {STATE}".split(", "))])
#: A missing time or id, which comes last; what a missing time counts as.
LAST, NEVER = (1 << 63) - 1, -(1 << 63)


class Standing:
    """What is known of an account, and the moves that a snapshot or the clock makes of it."""

    def __init__(self, params: RiskParams, row: tuple | None) -> None:
        self.params = params
        self.status, self.issued, self.ttl = row[:3] if row else (ACTIVE, None, None)
        self.last = tuple(row[3:]) if row and row[3] is not None else None
        self.moves: list[tuple] = []

    @property
    def deadline(self) -> int | None:
        """When an open call has been outstanding for too long."""
        return self.issued + self.params.escalation_minutes * MINUTE if self.status == MARGIN_CALL else None

    @property
    def due(self) -> int:
        """When the clock next has to look at it: an open call that is short is escalated, everything else runs out."""
        return self.deadline if self.deadline is not None and self.last is not None and self.last[2] < 0 else self.ttl

    def row(self) -> tuple:
        return (self.status, self.issued, self.ttl, *(self.last or (None,) * 6))

    def _move(self, kind: str, status: str, at: int, snapshot: tuple, failure: tuple = (None, None)) -> None:
        self.moves.append((self.issued, kind, at, snapshot[1], *snapshot[2:6], *failure))
        if kind != "LIQUIDATION_TRIGGERED":
            self.status, self.ttl = status, at + self.params.state_ttl_days * DAY

    def _restrict(self, at: int, snapshot: tuple) -> None:
        self._move("RESTRICTION_APPLIED", RESTRICTED, at, snapshot)
        if -snapshot[2] > snapshot[5] * self.params.liquidation_share:
            self._move("LIQUIDATION_TRIGGERED", RESTRICTED, at, snapshot)

    def run_out(self, now: int) -> None:
        """A state past its time to live is forgotten."""
        if self.ttl is not None and now >= self.ttl:
            self.status, self.issued, self.ttl, self.last = ACTIVE, None, None, None

    def escalate(self, now: int) -> None:
        """What the clock does by `now`: the call's account is restricted if its last snapshot was short."""
        due = self.deadline
        if due is not None and now > due and self.last is not None and self.last[0] <= due and self.last[2] < 0:
            self._restrict(due, self.last)

    def see(self, snapshot: tuple, thin: bool, clock: bool) -> None:
        """Moves for the snapshot (ts, event_id, excess, equity, total_mv, maintenance_req, scenario, excess_stressed)."""
        at, excess = snapshot[0], snapshot[2]
        if clock:
            self.escalate(at)
        self.run_out(at)
        if excess is not None and excess < 0:
            if self.status == MARGIN_CALL:
                if at > self.deadline:
                    self._restrict(at, snapshot)
            elif self.status != RESTRICTED:
                self.issued = at
                self._move("MARGIN_CALL_ISSUED", MARGIN_CALL, at, snapshot)
        elif thin and self.status == ACTIVE:
            self._move("WARNING_ISSUED", WARNING, at, snapshot)
        if self.status != RESTRICTED and snapshot[6] is not None:
            self._move("STRESS_RESTRICTION", RESTRICTED, at, snapshot, snapshot[6:8])
        if clock and self.status == MARGIN_CALL:
            self.last = snapshot[:6]


class LadderProcessor(StatefulProcessor):
    """Keeps the standings of a bucket of accounts; with `clock` a timer is set for the first of them that falls due."""

    def __init__(self, params: RiskParams, clock: bool) -> None:
        self.params, self.clock = params, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = Blocks(handle, "standings", BLOCK)

    def _read(self) -> dict[str | None, tuple]:
        columns = [c.to_pylist() for c in self.state.read().columns]
        return dict(zip(columns[0], zip(*columns[1:], strict=True), strict=True))

    def _done(self, before: dict[str | None, tuple], seen: dict[str | None, Standing]) -> Iterator[pd.DataFrame]:
        after, moves = dict(before), []
        for account, standing in seen.items():
            if standing.status == ACTIVE:
                after.pop(account, None)
            else:
                after[account] = standing.row()
            moves += [(account, *[None if x == NEVER else x for x in m]) for m in standing.moves]
        if after != before:
            rows = [(account, *row) for account, row in after.items()]
            self.state.write(pa.table([pa.array([row[k] for row in rows], f.type) for k, f in enumerate(BLOCK)], schema=BLOCK))
        if self.clock and after:
            due = min(Standing(self.params, row).due for row in after.values())
            self.handle.registerTimer(due // 1000 + 1)
        if moves:
            columns = zip(*moves, strict=True)
            yield pd.DataFrame({name: pd.Series(column, dtype=object) for name, column in zip(COLUMNS, columns, strict=True)})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before, seen = self._read(), {}
        batch = joined(rows).sort_values(["at", "event_id"])
        at, event = (batch[c].tolist() for c in ("at", "event_id"))
        values = [[None if x != x else x for x in batch[c].tolist()] for c in SNAPSHOT[2:]]
        for account, ts, number, thin, *rest in zip(batch["account_id"].tolist(), at, event, batch["thin"].tolist(), *values, strict=True):
            if account not in seen:
                seen[account] = Standing(self.params, before.get(account))
            snapshot = (NEVER if ts == LAST else ts, None if number == LAST else number, *rest)
            seen[account].see(snapshot, thin, self.clock)
        yield from self._done(before, seen)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before, seen = self._read(), {}
        now = timerValues.getCurrentWatermarkInMs() * 1000  # all that is due by then, so that one timer is enough
        for account, row in before.items():
            standing = Standing(self.params, row)
            if standing.due < now:
                seen[account] = standing
                standing.escalate(now)
                standing.run_out(now)
        if seen:
            yield from self._done(before, seen)


def ladder_state(
    snapshots: DataFrame, params: RiskParams = DEFAULT, stress: bool = False, clock: bool = False, buckets: int = BUCKETS
) -> DataFrame:
    """Actions over a stream of margin snapshots, one row of state per account; columns as of `ladder`.

    Equals the batch ladder where an account's rows come in order of time from one micro-batch to the next. States run out by
    their rows' time. With `clock` the stream needs a watermark on ts: an open call is escalated and a state forgotten once
    the watermark passes its time, and rows later than the watermark are dropped.
    """
    rows = judged(snapshots, params, stress)
    thin = is_warning(F.col("excess"), F.col("total_mv"), params)
    if not clock:
        rows = rows.filter(thin | (F.col("excess") < 0) | F.col("scenario").isNotNull())
    kind, key = snapshots.schema["ts"].dataType, rows.schema["account_id"].dataType
    last = F.lit(LAST)
    clocked = ["ts"] if clock else []  # by this column Spark drops rows later than the watermark
    rows = rows.select(
        bucket_of("account_id", buckets=buckets), F.col("account_id").cast("string").alias("account_id"),
        *clocked, F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), last).alias("at"), F.coalesce(F.col("event_id").cast("bigint"), last).alias("event_id"),
        *[F.col(c).cast("double").alias(c) for c in SNAPSHOT[2:]], F.coalesce(thin, F.lit(False)).alias("thin"),
    )
    moves = rows.groupBy(BUCKET).transformWithStateInPandas(LadderProcessor(params, clock), MOVES, "Update", "EventTime" if clock else "None")
    moves = moves.withColumns({c: F.timestamp_micros(c).cast(kind) for c in ("issued_at", "ts")})
    return described(moves.withColumn("account_id", F.col("account_id").cast(key)))
