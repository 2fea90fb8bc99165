"""Streams against the batch results, under splits, restarts and replays."""

from __future__ import annotations

import glob
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ballast.operators import asof, history, margin, positions
from ballast.params import TOPIC_FILLS, TOPIC_MARGIN, RiskParams
from ballast.schemas import MARGIN
from ballast.session import work_folder
from ballast.sources import events as wire
from ballast.streaming import enforcement, feeds, firm, job, ladder_state
from ballast.streaming import history as history_stream
from ballast.streaming import margin as margin_stream
from ballast.streaming import positions as position_stream
from ballast.streaming.progress import ProgressLog, progress_frame
from ballast.streaming.supervisor import Supervisor
from tests.conftest import rows
from tests.test_ladder import SCHEMA, event, random_events, taken, walk

T0 = datetime(2024, 1, 1)
ONCE = {"availableNow": True}


def feed_rows(seed):
    rnd = random.Random(seed)
    at = lambda: T0 + timedelta(seconds=rnd.randrange(5000))
    fills = [("hot" if n % 3 == 0 else f"a{rnd.randrange(8)}", f"s{rnd.randrange(6)}", rnd.randrange(-50, 99), at(), n) for n in range(120)]
    prices = [(f"s{rnd.randrange(5)}", float(rnd.randrange(100, 900)), at(), n) for n in range(60)]
    betas = [(f"s{n}", 0.5 + n / 4, T0, n) for n in range(4)]
    return fills, prices, betas


DDL = (
    "account_id STRING, symbol STRING, qty INT, ts TIMESTAMP_NTZ, seq BIGINT",
    "symbol STRING, price DOUBLE, ts TIMESTAMP_NTZ, seq BIGINT",
    "symbol STRING, beta DOUBLE, ts TIMESTAMP_NTZ, seq BIGINT",
)


def frames(spark, parts):
    return [spark.createDataFrame(p, d) for p, d in zip(parts, DDL)]


def cut(items, parts, seed=1):
    rnd = random.Random(seed)
    out = [[] for _ in range(parts)]
    for item in items:
        out[rnd.randrange(parts)].append(item)
    return out


def fed(spark, home, parts, ddl, start):
    """Run a query on one part of the rows after the other, restarted for each."""
    for part in parts:
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(f"{home}/in")
        start(spark.readStream.schema(ddl).parquet(f"{home}/in")).awaitTermination()


def logged(stream, home, mode="update"):
    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{home}/checkpoint").trigger(**ONCE)
        .foreachBatch(feeds.changelog(f"{home}/out")).start()
    )


@pytest.mark.parametrize("with_cash", [False, True])
def test_margin_stream_equals_batch(spark, with_cash):
    home = work_folder(spark, "test")
    whole = feed_rows(11)
    cash = spark.createDataFrame([("hot", -5000.0), ("a1", 100.0)], "account_id STRING, cash DOUBLE") if with_cash else None
    # every feed is cut at random; arrival order has nothing to do with event time
    slices = list(zip(*[cut(items, 3, 1 + k) for k, items in enumerate(whole)], strict=True))
    sink = margin_stream.MarginSink(home, cash)
    for slice_ in slices:
        for name, df in zip(("fills", "prices", "betas"), frames(spark, slice_)):
            df.coalesce(1).write.mode("append").parquet(f"{home}/in/{name}")
        streams = [spark.readStream.schema(d).parquet(f"{home}/in/{n}") for n, d in zip(("fills", "prices", "betas"), DDL)]
        for query in margin_stream.start_all(*streams, sink, home, ONCE, slices=2):
            query.awaitTermination()

    fills, prices, betas = frames(spark, whole)
    held = positions.net_positions(fills)
    kept = position_stream.held(spark, f"{home}/checkpoint/positions")
    assert rows(kept.select("account_id", "symbol", "qty")) == rows(held.select("account_id", "symbol", "qty"))
    price, beta = positions.latest_value(prices, "price"), positions.latest_value(betas, "beta", ("ts", "seq", "beta"))
    valued = positions.value_positions(held, positions.marks(price, beta))
    want = margin.account_margin(valued) if cash is None else margin.account_margin_cash(valued, cash)
    sent = (
        spark.read.schema("key STRING, value STRING, batch INT, topic STRING").parquet(f"{home}/out")
        .filter(F.col("topic") == TOPIC_MARGIN)
        .groupBy("key").agg(F.max_by("value", "batch").alias("value"))
        .select(F.from_json("value", MARGIN).alias("m"))
        .select("m.account_id", F.round("m.total_mv", 6).alias("mv"), F.round("m.excess", 6).alias("excess"))
    )
    assert rows(sent) == rows(want.select("account_id", F.round("total_mv", 6).alias("mv"), F.round("excess", 6).alias("excess")))


def test_a_tick_names_its_holders_and_nothing_else_is_read(spark):
    home = work_folder(spark, "test")
    parts = [
        [("position", "a", "X", 5, None, None), ("position", "b", "Y", 5, None, None), ("position", "c", "X", 2, None, None), ("price", None, "X", None, 10.0, [1])],
        [("position", "b", "Z", 1, None, None), ("position", "c", "X", -2, None, None)],
        [("price", None, "X", None, 11.0, [2])],  # reaches a, who holds it; c has sold
        [("price", None, "X", None, 9.0, [1])],  # older than what is known
        [("price", None, "X", None, 11.0, [3])],  # moves nothing
    ]
    ddl = "kind STRING, account_id STRING, symbol STRING, qty BIGINT, val DOUBLE, place ARRAY<BIGINT>"
    plans = []

    def start(stream):
        query = logged(position_stream.deltas(stream.withColumn("slice", F.lit(0))), home, "append")
        query.awaitTermination()
        plans.append(query._jsq.explainInternal(True))
        return query

    fed(spark, home, parts, ddl, start)
    changed = spark.read.schema(f"{position_stream.DELTAS}, batch INT").parquet(f"{home}/out")
    by = lambda n: rows(changed.filter(F.col("batch") == n).select("account_id", "mv_old", "mv_new"))
    assert by(0) == [("a", 0.0, 50.0), ("b", 0.0, 0.0), ("c", 0.0, 20.0)]
    assert by(1) == [("b", 0.0, 0.0), ("c", 20.0, 0.0)]
    assert by(2) == [("a", 50.0, 55.0)] and by(3) == [] and by(4) == []
    # the only relation that a batch scans is its own input
    physical = [text.partition("Physical Plan")[2] for text in plans]
    assert all(text.count("FileScan") == 1 for text in physical)
    total = position_stream.totals(changed.drop("batch"))
    assert rows(total.select("account_id", "total_mv", "positions")) == [("a", 55.0, 1), ("b", 0.0, 2), ("c", 0.0, 1)]


@pytest.mark.parametrize(("stress_too", "parts"), [(False, 1), (False, 10), (True, 3)])
def test_ladder_stream_equals_state_machine(spark, stress_too, parts):
    home = work_folder(spark, "test")
    events = sorted(random_events(21, 180), key=lambda e: (e[1], e[2]))
    size = -(-len(events) // parts)
    sink = enforcement.EnforcementSink(home)
    fed(
        spark, home, [events[k : k + size] for k in range(0, len(events), size)], SCHEMA,
        lambda stream: enforcement.start(stream, sink, f"{home}/checkpoint", ONCE, stress_too),
    )
    assert taken(spark.read.parquet(f"{home}/actions")) == walk(events, stress_too)


def test_expired_state_starts_over(spark):
    home = work_folder(spark, "test")
    snap = lambda n, days, excess: [("a", T0 + timedelta(days=days), n, 1000.0, 250.0 + excess, 250.0, excess, 0.0)]
    sink = enforcement.EnforcementSink(home)
    fed(spark, home, [snap(1, 0, -10.0), snap(2, 31, 20.0)], SCHEMA, lambda s: enforcement.start(s, sink, f"{home}/checkpoint", ONCE))
    got = spark.read.parquet(f"{home}/actions")
    assert {r.event_type for r in got.collect()} == {"MARGIN_CALL_ISSUED", "WARNING_ISSUED"}


def test_only_the_clock_can_restrict(spark):
    """Accounts a and b get no row after their call; only another account's rows move the watermark past its time."""
    home = work_folder(spark, "test")
    ddl = SCHEMA.replace("TIMESTAMP_NTZ", "TIMESTAMP")
    parts = [
        [event(1, 0, -0.20, "a"), event(2, 0, -0.01, "b"), event(3, 10, 0.30, "b"), event(4, 0, -0.01, "c")],
        [event(5, 20, 0.50, "z")],
        [event(6, 31, 0.50, "z")],
        [event(7, 40, 0.50, "c"), event(8, 41, -0.01, "b")],
    ]
    sink = enforcement.EnforcementSink(home)
    fed(
        spark, home, parts, ddl,
        lambda s: enforcement.start(s.withWatermark("ts", "5 seconds"), sink, f"{home}/checkpoint", ONCE, clock=True),
    )
    acts = spark.read.parquet(f"{home}/actions")
    found = sorted((r.account_id, r.event_type, r.event_id, (r.ts - datetime(2024, 1, 1, 10)).seconds // 60) for r in acts.collect())
    assert found == [
        ("a", "LIQUIDATION_TRIGGERED", 1, 30),
        ("a", "MARGIN_CALL_ISSUED", 1, 0),
        ("a", "RESTRICTION_APPLIED", 1, 30),  # no row came
        ("b", "MARGIN_CALL_ISSUED", 2, 0),
        ("b", "RESTRICTION_APPLIED", 8, 41),  # met at the time, short again later
        ("c", "MARGIN_CALL_ISSUED", 4, 0),
        ("c", "RESTRICTION_APPLIED", 4, 30),
    ]


def test_standing_is_one_row_of_state():
    params = RiskParams()
    one = ladder_state.Standing(params, None)
    one.see((0, 1, -10.0, 240.0, 1000.0, 250.0, None, None), False, True)
    again = ladder_state.Standing(params, one.row())
    assert (again.status, again.deadline, again.last) == ("MARGIN_CALL", 30 * 60_000_000, (0, 1, -10.0, 240.0, 1000.0, 250.0))
    again.escalate(again.deadline)
    assert not again.moves  # strictly later
    again.escalate(again.deadline + 1)
    assert [m[1] for m in again.moves] == ["RESTRICTION_APPLIED"] and again.deadline is None
    again.run_out(again.ttl)
    assert again.row() == ("ACTIVE", None, None, *[None] * 6)


def wire_rows(*items):
    """(account, qty, fill id, event second, second of arrival)."""
    return [
        (TOPIC_FILLS, a, f'{{"account_id":"{a}","symbol":"X","qty":{q},"price":1.0,"timestamp":{s * 1000},"fill_id":"{f}"}}', n, datetime.fromtimestamp(at))
        for n, (a, q, f, s, at) in enumerate(items)
    ]


def test_dedup_of_repeats_late_and_much_later_fills(spark):
    home = work_folder(spark, "test")
    hour = 3600

    def fills():
        got = wire.read_events(spark, {"path": f"{home}/in"}, TOPIC_FILLS, watermark=None)
        return got.withColumn("arrived", F.col("ts")).withColumn("ts", F.timestamp_millis("timestamp"))

    sizes = []

    def drain(*items):
        spark.createDataFrame(wire_rows(*items), wire.MESSAGE).coalesce(1).write.mode("append").parquet(f"{home}/in")
        feeds.start_record(fills(), f"{home}/record", f"{home}/c1", ONCE).awaitTermination()
        feeds.start_late(fills(), feeds.LateFills(f"{home}/record", f"{home}/late"), f"{home}/c2", ONCE).awaitTermination()
        late = spark.readStream.schema(fills().schema).option("recursiveFileLookup", "true").parquet(f"{home}/late/fills")
        query = (
            feeds.dedup(fills()).unionByName(late).writeStream.option("checkpointLocation", f"{home}/c3").trigger(**ONCE)
            .format("parquet").start(f"{home}/out")
        )
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])

    drain(("a", 1, "f1", 100, 100), ("a", 2, "f2", 101, 101), ("a", 1, "f1", 100, 130))
    drain(("a", 2, "f2", 101, 200), ("a", 10, "f3", 210, 220), ("a", 100, "f4", 5, 230))  # f2 again; f4 is late
    drain(("a", 1, "f1", 100, 3 * hour), ("a", 7, "f5", 60, 3 * hour), ("a", 7, "f5", 60, 3 * hour), ("b", 1, "g1", 3 * hour, 3 * hour))
    drain(("a", 7, "f5", 60, 9 * hour), ("a", 1, "f1", 100, 9 * hour), ("b", 1, "g2", 9 * hour, 9 * hour))
    out = spark.read.parquet(f"{home}/out")
    assert sorted(r.fill_id for r in out.collect()) == ["f1", "f2", "f3", "f4", "f5", "g1", "g2"]
    assert out.agg(F.sum("qty")).first()[0] == 1 + 2 + 10 + 100 + 7 + 1 + 1
    # ids older than the horizon are gone from the state
    assert sizes[-1] <= 2


def test_a_late_batch_that_runs_again_writes_nothing_new(spark):
    home = work_folder(spark, "test")
    ddl = "fill_id STRING, ts TIMESTAMP, arrived TIMESTAMP"
    spark.createDataFrame([("f1", T0.date())], "fill_id STRING, day DATE").write.partitionBy("day").parquet(f"{home}/record")
    late = spark.createDataFrame([("f1", T0, T0 + timedelta(days=2)), ("f2", T0, T0 + timedelta(days=2)), ("f2", T0, T0 + timedelta(days=2))], ddl)
    sink = feeds.LateFills(f"{home}/record", f"{home}/late")
    sink(late, 0)
    files = sorted(glob.glob(f"{home.removeprefix('file:')}/late/fills/*/*.parquet"))
    sink(late, 0)
    assert sorted(glob.glob(f"{home.removeprefix('file:')}/late/fills/*/*.parquet")) == files
    sink(late, 1)
    got = spark.read.schema(ddl).parquet(f"{home}/late/fills")
    assert [r.fill_id for r in got.collect()] == ["f2"]


def tick_rows(seed, n=260):
    rnd = random.Random(seed)
    out = [("hot" if k % 3 == 0 else f"s{rnd.randrange(5)}", rnd.choice([float(rnd.randrange(50, 90)), 0.0] + [60.0] * 5), T0 + timedelta(seconds=rnd.randrange(200)), k) for k in range(n)]
    return out + [("one", 5.0, T0, n), ("none", None, T0, n + 1)]


TICKS = "symbol STRING, price DOUBLE, ts TIMESTAMP_NTZ, seq BIGINT"


@pytest.mark.parametrize("parts", [1, 4])
def test_volatility_stream_equals_batch(spark, parts):
    home = work_folder(spark, "test")
    ticks = tick_rows(3)
    fed(spark, home, cut(ticks, parts), TICKS, lambda s: logged(history_stream.latest_volatility(s), home))
    got = feeds.newest(spark, f"{home}/out", history_stream.VOLATILITY.format(key="STRING"), ["symbol"])
    want = history.latest_volatility(spark.createDataFrame(ticks, TICKS).filter("price IS NOT NULL"))
    shown = lambda df: rows(df.select("symbol", F.round("volatility_annual", 6)))
    assert shown(got) == shown(want)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_stream_equals_batch(spark, strict):
    home = work_folder(spark, "test")
    kind = "kind STRING, account_id STRING, symbol STRING, price DOUBLE, ts TIMESTAMP, seq BIGINT"
    rnd = random.Random(9)
    ticks = [("tick", None, *t) for t in tick_rows(4)]
    fills = [("fill", f"a{k % 4}", rnd.choice(["hot", "s1", "s2", "none", None]), None, T0 + timedelta(seconds=rnd.randrange(200)), k) for k in range(90)]
    both = ticks + fills
    end = [("tick", None, "zz", 1.0, T0 + timedelta(hours=1), 0)]
    parts = [[r for r in both if lo <= (r[4] - T0).seconds < lo + 70] for lo in (0, 70, 140)] + [end]

    def halves(df):
        events = df.filter("kind = 'fill'").select("account_id", "symbol", "ts", "seq")
        return events, df.filter("kind = 'tick'").select("symbol", "price", "ts", "seq")

    def start(stream):
        matched = history_stream.as_of(*halves(stream.withWatermark("ts", "0 seconds")), "price", "mark", strict=strict, slices=2)
        return logged(matched, home, "append")

    fed(spark, home, parts, kind, start)
    want = asof.as_of(*halves(spark.createDataFrame(both, kind)), "price", "mark", strict=strict)
    got = spark.read.schema(want.schema).parquet(f"{home}/out").select(*want.columns)
    assert rows(got) == rows(want)


def test_firm_alert_only_when_the_limit_is_crossed(spark):
    home = work_folder(spark, "test")
    ddl = "account_id STRING, total_mv DOUBLE, beta_weighted_exposure DOUBLE, batch BIGINT"
    parts = [
        [("a", 10.0, 60.0, 0), ("b", 10.0, 30.0, 0)],
        [("a", 20.0, 80.0, 1)],
        [("b", 20.0, 40.0, 2), ("b", 99.0, 99.0, 1)],  # the older row doesn't count
        [("a", 1.0, 10.0, 3)],
        [("c", 5.0, 5.0, 4)],
    ]
    out = []
    for part in parts:
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(f"{home}/in")
        totals = spark.readStream.schema(ddl).parquet(f"{home}/in")
        for query in firm.start(totals, f"{home}/out", f"{home}/checkpoint", ONCE, RiskParams(firm_limit=100.0), buckets=3):
            query.awaitTermination()
    out = spark.read.schema(firm.FIRM).parquet(f"{home}/out/firm").orderBy("version")
    assert [(r.firm_beta_weighted_exposure, r.num_accounts, r.limit_breached, r.crossed) for r in out.collect()] == [
        (90.0, 2, False, None),
        (110.0, 2, True, "ABOVE"),
        (120.0, 2, True, None),
        (50.0, 2, False, "BELOW"),
        (55.0, 3, False, None),
    ]
    assert firm.alerts(out).count() == 2


def test_supervisor_restarts_a_query_that_fails(spark):
    home = work_folder(spark, "test")
    ddl = "account_id STRING, symbol STRING, qty INT, ts TIMESTAMP_NTZ, seq BIGINT"
    failures = []

    def starter(name):
        def write(df, n):
            if name == "broken" and not failures and n == 1:
                failures.append(n)
                raise ValueError("lost")
            df.write.mode("overwrite").parquet(f"{home}/out/{name}/batch={n}")

        return lambda: (
            spark.readStream.schema(ddl).parquet(f"{home}/in").writeStream.queryName(name).foreachBatch(write)
            .option("checkpointLocation", f"{home}/checkpoint/{name}").trigger(processingTime="0 seconds").start()
        )

    put = lambda n: spark.createDataFrame([("a", "X", n, T0, n)], ddl).coalesce(1).write.mode("append").parquet(f"{home}/in")
    put(1)
    job = Supervisor(spark, {name: starter(name) for name in ("broken", "sound")}).start()
    try:
        for n in (2, 3):
            for query in job.running.values():
                if query.isActive:
                    try:
                        query.processAllAvailable()
                    except Exception:  # noqa: BLE001
                        pass
            put(n)
            job.watch(seconds=4)
        job.running["sound"].stop()  # killed from outside
        job.watch(seconds=3)
        put(4)
        job.watch(seconds=5)
        for query in job.running.values():
            query.processAllAvailable()
        for name in ("broken", "sound"):
            got = spark.read.schema(ddl).parquet(f"{home}/out/{name}")
            assert sorted(r.qty for r in got.collect()) == [1, 2, 3, 4]
        assert failures and {n: len(t) for n, t in job.begun.items()} == {"broken": 2, "sound": 2}
    finally:
        job.stop()


def test_supervisor_gives_up_on_a_query_that_always_fails(spark):
    home = work_folder(spark, "test")
    spark.createDataFrame([("a",)], "x STRING").write.parquet(f"{home}/in")

    def fail(df, n):
        raise ValueError("always")

    def start():
        return (
            spark.readStream.schema("x STRING").parquet(f"{home}/in").writeStream.foreachBatch(fail)
            .option("checkpointLocation", f"{home}/checkpoint").start()
        )

    with pytest.raises(Exception, match="always"):
        Supervisor(spark, {"bad": start}, restarts=1).start().watch(seconds=30)


def test_the_whole_job_under_one_supervisor(spark):
    """Each query drains what is there; a round carries the messages one query further."""
    home = work_folder(spark, "test")
    fill = lambda a, s, q, f: (TOPIC_FILLS, a, f'{{"account_id":"{a}","symbol":"{s}","qty":{q},"price":1.0,"timestamp":{int(T0.timestamp() * 1000)},"fill_id":"{f}"}}')
    tick = lambda s, p: ("prices.v1", s, f'{{"symbol":"{s}","price":{p},"timestamp":1}}')
    sent = [fill("a", "X", 5, "f1"), fill("a", "X", 5, "f1"), fill("b", "X", -2, "f2"), tick("X", 10.0), tick("X", 11.0), tick("X", 12.0), ("prices.v1", "X", "{"), ("nobody.v1", "k", "{}")]
    data = [(topic, key, value, n, T0 + timedelta(seconds=n)) for n, (topic, key, value) in enumerate(sent)]
    spark.createDataFrame(data, wire.MESSAGE).coalesce(1).write.parquet(f"{home}/wire")
    starters = job.starters(spark, {"path": f"{home}/wire"}, home, ONCE, slices=2, buckets=2)
    for _ in range(5):
        Supervisor(spark, starters, endless=False).start().watch(seconds=240)
    margin_rows = spark.read.schema("key STRING, value STRING, batch INT, topic STRING").parquet(f"{home}/margin/out").filter(F.col("topic") == TOPIC_MARGIN)
    got = {r.m.account_id: r.m.total_mv for r in margin_rows.select(F.from_json("value", MARGIN).alias("m")).collect()}
    assert got == {"a": 60.0, "b": -24.0}
    assert spark.read.parquet(f"{home}/dead").count() == 2
    latest = spark.read.schema("topic STRING, key STRING, value STRING, batch INT").parquet(f"{home}/volatility").collect()
    assert {r.topic for r in latest} == {"volatility.v1"} and '"ticks":3' in latest[-1].value
    last = spark.read.schema("topic STRING, key STRING, value STRING, batch INT").parquet(f"{home}/firm_risk").orderBy(F.desc("batch")).first()
    assert (last.topic, '"firm_total_mv":36.0' in last.value, '"num_accounts":2' in last.value) == ("firm.risk.v1", True, True)
    # a short account has a negative requirement, so its excess is below 0
    acts = {(r.account_id, r.event_type) for r in spark.read.parquet(f"{home}/enforcement/actions").collect()}
    assert acts == {("b", "MARGIN_CALL_ISSUED")}


def test_progress(spark):
    home = work_folder(spark, "test")
    spark.createDataFrame(wire_rows(("a", 1, "f", 1, 1), ("b", 1, "g", 1, 1)), wire.MESSAGE).write.parquet(f"{home}/in")
    log = ProgressLog(spark, f"{home}/log")
    spark.streams.addListener(log)
    query = (
        feeds.running_positions(wire.read_events(spark, {"path": f"{home}/in"}, TOPIC_FILLS))
        .writeStream.outputMode("update").queryName("p").option("checkpointLocation", f"{home}/c")
        .trigger(**ONCE).format("noop").start()
    )
    query.awaitTermination()
    first = progress_frame(spark, query).orderBy("batch_id").first()
    assert (first.query, first.input_rows, first.state_rows) == ("p", 2, 2)
    deadline = time.time() + 30
    while time.time() < deadline and not glob.glob(f"{home.removeprefix('file:')}/log/_SUCCESS"):
        time.sleep(0.2)
    spark.streams.removeListener(log)
    assert log.frame().agg(F.sum("input_rows")).first()[0] == 2
