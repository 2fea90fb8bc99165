"""The grid position by position holds one group for an account, not one for each move."""

from __future__ import annotations

from ballast.operators import stress
from ballast.params import GRID_SCENARIOS, GRID_TAG
from tests.conftest import rows


def test_moves_are_added_up_side_by_side(spark):
    held = [("a", 10.0), ("a", -4.0), ("b", 7.0), ("b", None), (None, 3.0), ("c", None)]
    out = stress.grid_pnl_by_position(spark.createDataFrame(held, "account_id STRING, market_value DOUBLE"))
    sums = {"a": [10.0, -4.0], "b": [7.0], None: [3.0], "c": []}
    want = [(a, sum(v * s for v in values) if values else None, s, GRID_TAG) for a, values in sums.items() for s in GRID_SCENARIOS]
    shown = lambda found: sorted(((a, None if p is None else round(p, 9), s, t) for a, p, s, t in found), key=repr)
    assert shown(rows(out)) == shown(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("HashAggregate")  # the moves come after the sums
