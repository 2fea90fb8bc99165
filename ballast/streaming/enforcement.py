"""Streaming enforcement: the ladder as keyed state, its actions, state rows and audit trail as one sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ballast.operators import audit as audit_ops
from ballast.operators.ladder import state_history
from ballast.params import DEFAULT, RiskParams
from ballast.streaming.ladder_state import ladder_state


class EnforcementSink:
    """Body of foreachBatch over actions: actions/, history/ and audit/ below ``path``, a folder per batch each."""

    def __init__(self, path: str, params: RiskParams = DEFAULT) -> None:
        self.path, self.params = path, params

    def __call__(self, taken: DataFrame, batch_id: int) -> None:
        taken = taken.persist()  # a stateful plan runs once
        for kind, rows in (("actions", taken), ("history", state_history(taken, self.params)), ("audit", audit_ops.audit_events(taken))):
            rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={batch_id}")
        taken.unpersist()


def start(
    snapshots: DataFrame,
    sink: EnforcementSink,
    checkpoint: str,
    trigger: dict | None = None,
    stress: bool = False,
    clock: bool = False,
):
    """Start the ladder over a stream of margin snapshots; ``clock`` needs a watermark, see `ladder_state`."""
    return (
        ladder_state(snapshots, sink.params, stress, clock)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .queryName("enforcement")
        .foreachBatch(sink)
        .start()
    )
