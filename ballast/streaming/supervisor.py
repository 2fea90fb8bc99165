"""All queries of the job under one roof: started together, each in its scheduler pool, restarted from its checkpoint."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

POOL = "spark.scheduler.pool"
log = logging.getLogger(__name__)


class Supervisor:
    """Keeps named queries running.

    ``starters`` give a query each, from its own checkpoint. With `spark.scheduler.mode` FAIR each query has a pool, so that a
    long batch of one doesn't hold up the others. A query that ends is started again, at most ``restarts`` times within
    ``window`` seconds; beyond that its last error ends the job. With ``endless`` false a query that ends well is done.
    """

    def __init__(self, spark: SparkSession, starters: dict[str, Callable[[], StreamingQuery]], restarts: int = 3, window: float = 600.0, endless: bool = True) -> None:
        self.spark, self.starters, self.restarts, self.window, self.endless = spark, dict(starters), restarts, window, endless
        self.running: dict[str, StreamingQuery] = {}
        self.begun: dict[str, list[float]] = {name: [] for name in starters}

    def _start(self, name: str) -> None:
        context = self.spark.sparkContext
        before = context.getLocalProperty(POOL)
        context.setLocalProperty(POOL, name)
        try:
            self.running[name] = self.starters[name]()
        finally:
            context.setLocalProperty(POOL, before)
        self.begun[name].append(time.monotonic())

    def start(self) -> Supervisor:
        for name in self.starters:
            self._start(name)
        return self

    def _ended(self) -> None:
        for name, query in list(self.running.items()):
            if query.isActive:
                continue
            error = query.exception()
            del self.running[name]
            if error is None and not self.endless:
                continue
            recent = [t for t in self.begun[name] if t > time.monotonic() - self.window]
            if len(recent) > self.restarts:
                self.stop()
                raise error or RuntimeError(f"{name} has ended {len(recent)} times")
            log.warning("%s has ended and is started again: %s", name, error)
            self._start(name)

    def watch(self, seconds: float | None = None) -> None:
        """Wait for any query to end, and start it again; for so many seconds, or until all are done."""
        until = None if seconds is None else time.monotonic() + seconds
        while self.running and (until is None or time.monotonic() < until):
            try:
                self.spark.streams.awaitAnyTermination(1 if until is None else max(0.1, min(1.0, until - time.monotonic())))
            except StreamingQueryException:
                pass  # which one it was, and its error, is asked below
            self.spark.streams.resetTerminated()
            self._ended()

    def stop(self) -> None:
        for query in self.running.values():
            query.stop()
        self.running.clear()
