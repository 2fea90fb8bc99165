"""What the streamed margin job sends on, reads and parses."""

from __future__ import annotations

import hashlib
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ballast.functions.columns import stable_id
from ballast.operators import positions
from ballast.plans import streams
from ballast.session import work_folder
from ballast.sources import tables
from ballast.streaming import feeds
from ballast.streaming import positions as position_stream


def test_a_task_sends_only_ticks_that_can_be_the_newest(spark):
    lines = [(s, t, seq, (s * 7 + (t or 0) * 3 + (seq or 0)) % 11 / 10) for s in range(40) for t in (None, *range(30)) for seq in (None, 1, 2)]
    lines += [(None, 5, 1, 0.5), (3, 29, 2, 9.0), (3, 29, 2, 8.0)]  # equals all stay
    df = spark.createDataFrame(lines, "symbol BIGINT, t BIGINT, seq BIGINT, price DOUBLE").repartition(1)
    ranks = [F.coalesce(c, F.lit(-(1 << 62))) for c in (F.col("t"), F.col("seq"))]
    got = position_stream.newest_rows(df, "symbol", ranks).collect()
    assert len(got) == 40 + 1 + 2
    assert all((r.t, r.seq) == ((29, 2) if r.symbol is not None else (5, 1)) for r in got)
    assert sorted(r.price for r in got if r.symbol == 3)[1:] == [8.0, 9.0]
    old, position_stream.GATHERED = position_stream.GATHERED, 7  # whatever is gathered before it is looked at
    try:
        assert sorted(map(repr, position_stream.newest_rows(df, "symbol", ranks).collect())) == sorted(map(repr, got))
    finally:
        position_stream.GATHERED = old


def test_the_margin_job_joins_only_the_newest_ticks_with_list_prices(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").coalesce(1)
    few = streams._newest_lines(lines)
    assert few.count() < lines.count() / 4
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    newest = lambda rows: sorted(map(tuple, positions.latest_value(tables.project_prices(rows, parts), "price").collect()))
    assert newest(few) == newest(lines)


def test_late_fills_are_read_once(spark):
    home, seen = work_folder(spark, "test"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    ddl = "fill_id STRING, ts TIMESTAMP, arrived TIMESTAMP"
    at = datetime(2024, 1, 2)
    late = spark.createDataFrame([(f"f{k}", at, at + timedelta(days=2)) for k in range(50)], ddl).mapInArrow(counted, ddl)
    spark.createDataFrame([("f0", at.date())], "fill_id STRING, day DATE").write.partitionBy("day").parquet(f"{home}/record")
    feeds.LateFills(f"{home}/record", f"{home}/late")(late, 0)
    assert seen.value == 50
    assert spark.read.parquet(f"{home}/late/fills").count() == 49


def test_ids_are_made_without_patterns(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|c"), (None, "\\N"), ("\\N", None)], "x STRING, y STRING")
    ids = df.select(stable_id("x", "y").alias("id"))
    escaped = ["a\\|b|c", "a|b\\|c", "a\\\\|\\|c", "\\N|\\\\N", "\\\\N|\\N"]
    assert [r.id for r in ids.collect()] == [hashlib.sha256(t.encode()).hexdigest() for t in escaped]
    assert "regexp" not in ids._jdf.queryExecution().optimizedPlan().toString().lower()
