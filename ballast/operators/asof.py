"""As-of join: the value in force at each event's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.skew import CARRIED, SEGMENT, carry_last, hot_keys, segment_window
from ballast.params import SCALE, Scale


def as_of(
    events: DataFrame,
    ticks: DataFrame,
    value: str,
    name: str,
    key: str = "symbol",
    tick_order: Sequence[str] = ("seq",),
    strict: bool = False,
    hot: DataFrame | None = None,
    scale: Scale = SCALE,
) -> DataFrame:
    """Add ``name``: the last tick's ``value`` at or before (``strict``: before) ``ts``.

    Events and ticks are laid in one time line per key and the last value seen
    is carried along it: one shuffle and a sort, no range join. Ticks of one
    instant rank by ``tick_order``, then value.
    """
    tick_turn, event_turn = (1, 0) if strict else (0, 1)
    line = events.select(
        *events.columns,
        F.lit(event_turn).alias("_turn"),
        F.lit(True).alias("_event"),
        # tells events of one instant apart where a key's rows are cut; ticks are told apart by their own order
        F.xxhash64(*events.columns).alias("_tie"),
    ).unionByName(
        ticks.select(
            key,
            "ts",
            F.lit(tick_turn).alias("_turn"),
            F.lit(False).alias("_event"),
            F.struct(*tick_order, value).alias("_tick_order"),
            F.col(value).alias("_value"),
        ),
        allowMissingColumns=True,
    )
    hot = hot_keys(line, [key], scale) if hot is None else hot
    order = ["ts", "_turn", "_tick_order"]
    rows = carry_last(line, [key], [*order, "_tie"], "_value", hot, scale)
    # events without a key match nothing; keep them from piling up in one task
    alone = F.xxhash64(*events.columns)
    rows = rows.withColumn(SEGMENT, F.when(F.col(key).isNull(), alone).otherwise(F.col(SEGMENT)))
    along = segment_window([key], [F.col(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn(name, F.last("_value", ignorenulls=True).over(along))
        .filter(F.col("_event") & ~F.col(CARRIED))
        .select(*events.columns, name)
    )
