"""Registered streaming queries: run over the whole tables until all is processed.

Input arrives in several slices with the query stopped and restarted from its
checkpoint between them, so every run also exercises recovery.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.functions.columns import tidy
from ballast.params import TOPIC_BETAS, TOPIC_FILLS, TOPIC_MARGIN, TOPIC_PRICES, TOPIC_STRESS
from ballast.plans import fixtures
from ballast.plans.catalog import ACTION_COLUMNS, EXACT, MARGIN_SUMS, STRESS_SUMS
from ballast.schemas import MARGIN, STRESS
from ballast.session import SETTINGS, work_folder
from ballast.sources import events as wire
from ballast.sources import tables
from ballast.streaming import enforcement, feeds, firm, history
from ballast.streaming import margin as margin_stream
from ballast.streaming import positions as position_stream
from ballast.streaming.progress import append_progress

ONCE = {"availableNow": True}
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Slices of a symbol's holders in these runs.
FEW = 2


def _keyed_state(spark: SparkSession) -> None:
    spark.conf.set(PROVIDER, SETTINGS[PROVIDER])


def _drain(start: Callable[[], object]):
    query = start()
    query.awaitTermination()
    return query


def _sweep(spark: SparkSession) -> None:
    """Let go of shuffle files of queries that have ended: Spark removes them once the driver's heap is collected, by itself each half hour."""
    gc.collect()  # Python's handles on them
    spark.sparkContext._jvm.System.gc()


def _slices(df: DataFrame, by: Column, parts: Iterable[int], inbox: str, start: Callable[[], object]) -> None:
    """Write one slice after the other to ``inbox`` and run the query on each."""
    for part in parts:
        df.filter(by == part).write.mode("append").parquet(inbox)
        _drain(start)


def _updates(stream: DataFrame, path: str, checkpoint: str):
    """Start a query that keeps each micro-batch's changed rows."""
    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**ONCE)
        .foreachBatch(feeds.changelog(path))
        .start()
    )


def _message_feed(spark, root, topic, build, keys, by, parts) -> DataFrame:
    """Replay the event table as messages and keep ``build``'s running result by key."""
    home = work_folder(spark, "feed")
    messages = fixtures.replay_messages(tables.table(spark, root, "events"))

    def running():
        return build(wire.read_events(spark, {"path": f"{home}/in"}, topic))

    _slices(messages, by, parts, f"{home}/in", lambda: _updates(running(), f"{home}/out", f"{home}/checkpoint"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in running().schema)
    return feeds.newest(spark, f"{home}/out", schema, keys).withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))


def _day_third() -> Column:
    return F.floor((F.dayofmonth("timestamp") - 1) / 11).cast("int")


def stream_fills(spark: SparkSession, root: str) -> DataFrame:
    return _message_feed(
        spark, root, TOPIC_FILLS, feeds.running_positions, ["account_id", "symbol"], F.col("offset") % 3, range(3)
    )


def stream_prices(spark: SparkSession, root: str) -> DataFrame:
    return _message_feed(
        spark, root, TOPIC_PRICES, feeds.running_prices, ["symbol"], F.col("offset") % 3, range(3)
    )


def stream_betas(spark: SparkSession, root: str) -> DataFrame:
    return _message_feed(
        spark, root, TOPIC_BETAS, feeds.running_betas, ["symbol"], F.col("offset") % 3, range(3)
    )


def stream_late(spark: SparkSession, root: str) -> DataFrame:
    """Newest days first: everything after the first slice is late, and still counts."""
    return _message_feed(
        spark, root, TOPIC_FILLS, feeds.running_positions, ["account_id", "symbol"], _day_third(), (2, 1, 0)
    ).drop("last_updated")


def _unique_fills(
    spark: SparkSession, home: str, fills: Callable[[], DataFrame], read: Callable[[DataFrame], None], period: str = "day"
) -> None:
    """Run the queries on repeated and late fills on what has come: ids on record, much later fills, then ``read``."""
    _drain(lambda: feeds.start_record(fills(), f"{home}/record", f"{home}/checkpoint/record", ONCE, period=period))
    sink = feeds.LateFills(f"{home}/record", f"{home}/late", period)
    _drain(lambda: feeds.start_late(fills(), sink, f"{home}/checkpoint/late", ONCE))
    schema = fills().schema
    late = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{home}/late/fills")
    read(feeds.dedup(fills()).select(*schema.names).unionByName(late.select(*schema.names)))


def stream_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Each fill once, be it repeated soon, repeated days later, or first delivered days later."""
    _keyed_state(spark)
    home = work_folder(spark, "dedup")
    events = tables.table(spark, root, "events")
    messages = fixtures.replay_messages(events)
    sent = fixtures.deliveries(messages, F.col("offset"), F.col("timestamp"), _day_third(), "11 DAYS")
    sent = sent.withColumn("timestamp", F.col("arrived")).drop("arrived")

    def fills():
        rows = wire.read_events(spark, {"path": f"{home}/in"}, TOPIC_FILLS, watermark=None)
        return rows.withColumn("arrived", F.col("ts")).withColumn("ts", F.timestamp_millis("timestamp"))

    def keep(unique: DataFrame) -> None:
        out = unique.writeStream.option("checkpointLocation", f"{home}/checkpoint/out").trigger(**ONCE)
        out.format("parquet").start(f"{home}/out").awaitTermination()

    for part in range(5):
        sent.filter(F.col("slice") == part).drop("slice").write.mode("append").parquet(f"{home}/in")
        _unique_fills(spark, home, fills, keep)
    # the table has the time in full, the wire only milliseconds
    at = events.select(F.col("event_id").cast("string").alias("fill_id"), "ts")
    return spark.read.parquet(f"{home}/out").select("fill_id", "account_id", "symbol", "qty").join(at, "fill_id")


def stream_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """What the running stream cannot use, as its own query keeps it."""
    home = work_folder(spark, "dead")
    messages = fixtures.replay_messages(tables.table(spark, root, "events"))

    def start():
        sent = wire.read_messages(spark, {"path": f"{home}/in"})
        return wire.write_dead_letters(sent, f"{home}/out", f"{home}/checkpoint", ONCE)

    _slices(messages, F.col("offset") % 2, range(2), f"{home}/in", start)
    return spark.read.parquet(f"{home}/out").select("topic", "key", "offset", "reason")


# margin --------------------------------------------------------------------

#: Line items up to here come in the first part of the margin feed, later ones in the second.
HALF = "TIMESTAMP '1998-06-01 00:00:00'"


def _ticks(spark: SparkSession, root: str, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Streams of prices from line items, and of betas from the part table."""
    parts = tables.table(spark, root, "part")
    # a pattern, because a stream takes no path of a single file
    listed = spark.readStream.schema(parts.schema).parquet(f"{root}/part.parque[t]")
    no_seq = F.struct(
        F.lit(None).cast("bigint").alias("l_orderkey"),
        F.lit(None).cast("int").alias("l_linenumber"),
        F.lit(None).cast("bigint").alias("l_suppkey"),
    )
    betas = tables.project_betas(listed).select(
        "symbol", "beta", F.lit("1970-01-01").cast("timestamp_ntz").alias("ts"), no_seq.alias("seq")
    )
    return tables.project_prices(lines, parts).drop("p_retailprice"), betas


def _newest_lines(lines: DataFrame) -> DataFrame:
    """Line items that can be the newest tick of their symbol in a micro-batch: a task's other ones never meet their list price."""
    known = lines.filter("l_partkey IS NOT NULL").withColumn("_factor", F.expr(tables.FACTOR)).filter("_factor IS NOT NULL AND NOT isnan(_factor)")
    needed = known.select("l_partkey", "l_tax", "l_discount", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")
    ranks = position_stream.place_numbers(F.col("l_shipdate"), [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")])
    return position_stream.newest_rows(needed, "l_partkey", ranks)


class _Margin:
    """The margin job over line items delivered in four parts, fills repeated, late and much later."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        _keyed_state(spark)
        self.spark, self.root, self.home = spark, root, work_folder(spark, "margin")
        self.sink, self.last = margin_stream.MarginSink(self.home), []
        lines = tables.table(spark, root, "lineitem")
        part = F.when(F.col("l_shipdate") <= F.expr(HALF), 0).otherwise(1)
        self.sent = fixtures.deliveries(lines, F.col("l_orderkey"), F.col("l_shipdate"), part, "2000 DAYS")
        self.schema = self.sent.drop("slice").schema

    def lines(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(f"{self.home}/in")

    def fills(self) -> DataFrame:
        """Fills as line items name them: the columns of a line item, its id and the times."""
        rows = self.lines().withColumn("arrived", F.col("arrived").cast("timestamp"))
        return rows.withColumn("fill_id", fixtures.fill_id()).withColumn("ts", F.col("l_shipdate").cast("timestamp"))

    def step(self, part: int) -> list:
        self.sent.filter(F.col("slice") == part).drop("slice").write.mode("append").parquet(f"{self.home}/in")
        queries = []

        def read(unique: DataFrame) -> None:
            orders = tables.table(self.spark, self.root, "orders")
            prices, betas = _ticks(self.spark, self.root, _newest_lines(self.lines()))
            fills = tables.project_fills(unique.drop("ts"), orders)
            queries.extend(margin_stream.start_all(fills, prices, betas, self.sink, self.home, ONCE, FEW))

        _unique_fills(self.spark, self.home, self.fills, read, "year")  # line items span years
        for query in queries:
            query.awaitTermination()
        _sweep(self.spark)
        return queries

    def run(self) -> _Margin:
        """All four parts; `last` is the number of the last batch of totals of each."""
        for part in range(4):
            self.step(part)
            self.last.append(self.totals().agg(F.max("batch")).first()[0])
        return self

    def totals(self) -> DataFrame:
        return self.spark.read.schema(f"{margin_stream.TOTALS}, batch BIGINT").parquet(f"{self.home}/totals")


# one run of the job serves all queries on its results, within a session and for the same tables
_RUNS: dict[tuple[str, str], _Margin] = {}


def _margin_run(spark: SparkSession, root: str) -> _Margin:
    key = (spark.sparkContext.applicationId, root)
    if key not in _RUNS:
        _RUNS[key] = _Margin(spark, root).run()
    return _RUNS[key]


def stream_state(spark: SparkSession, root: str) -> DataFrame:
    """Positions and marks as the margin job's state holds them at the end."""
    checkpoint = f"{_margin_run(spark, root).home}/checkpoint/positions"
    none = F.lit(None).cast("double")
    held = position_stream.held(spark, checkpoint)
    marks = position_stream.marked(spark, checkpoint)
    positions = held.select(F.lit("position").alias("kind"), "account_id", "symbol", F.col("qty").cast("double").alias("qty"), none.alias("val"))
    both = F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("val")) for kind in ("price", "beta")]))
    quoted = marks.select("symbol", both).select("kind", F.lit("").alias("account_id"), "symbol", none.alias("qty"), "val")
    return positions.union(quoted.filter("val IS NOT NULL"))


def stream_margin_delta(spark: SparkSession, root: str) -> DataFrame:
    """Margin from account totals that only differences have moved."""
    job = _margin_run(spark, root)
    totals = feeds.newest(spark, f"{job.home}/totals", margin_stream.TOTALS, ["account_id"])
    rows = margin_stream.results(totals).filter(F.col("topic") == TOPIC_MARGIN).select(F.from_json("value", MARGIN).alias("m")).select("m.*")
    return _margin_report(rows.withColumn("account_id", F.col("account_id").cast("bigint")))


def _margin_report(rows: DataFrame) -> DataFrame:
    rows = rows.select("account_id", *MARGIN_SUMS, "excess_pct").withColumns({n: tidy(F.col(n), EXACT) for n in MARGIN_SUMS})
    return rows.withColumn("excess_pct", tidy(F.col("excess_pct"), 6))


def stream_touched_accounts(spark: SparkSession, root: str) -> DataFrame:
    """For each part of the feed how many accounts it touched: those that traded and the holders of symbols that moved."""
    job = _margin_run(spark, root)
    first, second = job.last[:2]
    part = F.when(F.col("batch") <= first, 0).when(F.col("batch") <= second, 1).alias("part")
    touched = job.totals().select(part, "account_id").filter("part IS NOT NULL")
    return touched.groupBy("part").agg(F.count_distinct("account_id").alias("accounts"))


def _newest_messages(spark, sink, topic: str, schema: str) -> DataFrame:
    """Messages of the last batch that spoke of an account."""
    out = spark.read.schema("key STRING, value STRING, batch BIGINT, topic STRING").parquet(f"{sink.path}/out")
    out = out.filter(F.col("topic") == topic)
    newest = out.groupBy("key").agg(F.max("batch").alias("batch"))
    # only what counts is parsed
    return out.join(newest, ["key", "batch"]).select(F.from_json("value", schema).alias("data")).select("data.*")


def margin_json(spark: SparkSession, root: str) -> DataFrame:
    return _margin_report(_newest_messages(spark, _margin_run(spark, root).sink, TOPIC_MARGIN, MARGIN))


def stress_json(spark: SparkSession, root: str) -> DataFrame:
    rows = _newest_messages(
        spark, _margin_run(spark, root).sink, TOPIC_STRESS, f"{STRESS}, portfolio_pnl DOUBLE"
    ).drop("calc_timestamp")
    return rows.withColumns({n: tidy(F.col(n), EXACT) for n in (*STRESS_SUMS, "portfolio_pnl")}).withColumn(
        "underwater", F.col("underwater").cast("string")
    )


def stream_firm_risk(spark: SparkSession, root: str) -> DataFrame:
    """The firm's totals after each half of the feed, and whether its exposure passed the limit."""
    job = _margin_run(spark, root)
    home = work_folder(spark, "firm")
    first, second = job.last[:2]
    changed = job.totals().filter(F.col("batch") <= second)
    for part in (changed.filter(F.col("batch") <= first), changed.filter(F.col("batch") > first)):
        part.write.mode("append").parquet(f"{home}/in")
        totals = spark.readStream.schema(f"{margin_stream.TOTALS}, batch BIGINT").parquet(f"{home}/in")
        for query in firm.start(totals, f"{home}/out", f"{home}/checkpoint", ONCE, buckets=8):
            query.awaitTermination()
    rows = spark.read.schema(firm.FIRM).parquet(f"{home}/out/firm")
    sums = ("firm_beta_weighted_exposure", "firm_total_mv")
    return rows.withColumns({n: tidy(F.col(n), 1) for n in sums}).withColumn("version", F.col("version").cast("int"))


# price history -------------------------------------------------------------


def stream_volatility(spark: SparkSession, root: str) -> DataFrame:
    """Latest volatility per symbol from ticks in no order of time."""
    _keyed_state(spark)
    home = work_folder(spark, "volatility")
    lines = tables.table(spark, root, "lineitem")

    def start():
        ticks = _ticks(spark, root, spark.readStream.schema(lines.schema).parquet(f"{home}/in"))[0]
        return _updates(history.latest_volatility(ticks), f"{home}/out", f"{home}/checkpoint")

    _slices(lines, F.col("l_orderkey") % 3, range(3), f"{home}/in", start)
    rows = feeds.newest(spark, f"{home}/out", history.VOLATILITY.format(key="BIGINT"), ["symbol"])
    return rows.select("symbol", tidy(F.col("volatility_annual"), 6).alias("volatility_annual"))


def stream_asof(spark: SparkSession, root: str) -> DataFrame:
    """Fills with the mark in force at their time, from feeds in order of time."""
    _keyed_state(spark)
    home = work_folder(spark, "asof")
    orders, parts = tables.table(spark, root, "orders"), tables.table(spark, root, "part")
    lines = tables.table(spark, root, "lineitem")
    # the clock goes on after the last line item: one of no known order or symbol, a day later
    last = lines.agg(F.max("l_shipdate").alias("l_shipdate")).select(
        *[
            (F.col(f.name) + F.expr("INTERVAL 1 DAY") if f.name == "l_shipdate" else F.lit(-1 if f.name.endswith("key") else None).cast(f.dataType)).alias(f.name)
            for f in lines.schema
        ]
    )
    year = F.year("l_shipdate")
    sent = lines.withColumn("slice", F.when(year < 1997, 0).when(year < 1999, 1).otherwise(2))
    sent = sent.unionByName(last.withColumn("slice", F.lit(3)))

    def start():
        read = lambda: spark.readStream.schema(lines.schema).parquet(f"{home}/in").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).withWatermark("l_shipdate", "0 seconds")
        matched = history.as_of(tables.project_fills(read(), orders, parts), tables.project_prices(read(), parts), "price", "mark", slices=FEW)
        return matched.writeStream.option("checkpointLocation", f"{home}/checkpoint").trigger(**ONCE).format("parquet").start(f"{home}/out")

    for part in range(4):
        sent.filter(F.col("slice") == part).drop("slice").write.mode("append").parquet(f"{home}/in")
        _drain(start)
        _sweep(spark)
    return spark.read.parquet(f"{home}/out").select(
        "account_id", "symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), "seq.l_orderkey", "seq.l_linenumber", "qty", "price", "mark"
    )


# enforcement ---------------------------------------------------------------


def _run_ladder(spark: SparkSession, root: str, stress: bool, spread: bool = False, slices: int = 3):
    _keyed_state(spark)
    home = work_folder(spark, "ladder")
    sink = enforcement.EnforcementSink(home)
    schema = tables.table(spark, root, "events").schema

    def start():
        snapshots = tables.project_margin_events(spark.readStream.schema(schema).parquet(f"{home}/in"))
        snapshots = fixtures.spread_out(snapshots) if spread else snapshots
        return enforcement.start(snapshots, sink, f"{home}/checkpoint", ONCE, stress)

    # an account's events carry one day of the month, so slice by the hour
    by = F.floor(F.hour("ts") * slices / 24).cast("int")
    if spread:
        by = F.floor((F.dayofmonth("ts") - 1 + F.col("event_id") % 5 * 20) / 40).cast("int")
    _slices(tables.table(spark, root, "events"), by, range(slices), f"{home}/in", start)
    return sink


def _ladder_report(spark: SparkSession, sink) -> DataFrame:
    rows = spark.read.parquet(f"{sink.path}/actions")
    return rows.select(*ACTION_COLUMNS).withColumns(
        {n: tidy(F.col(n), EXACT) for n in ("deficiency", "excess", "excess_stressed")}
    )


def stream_ladder(spark: SparkSession, root: str) -> DataFrame:
    return _ladder_report(spark, _run_ladder(spark, root, False))


def stream_ladder_combined(spark: SparkSession, root: str) -> DataFrame:
    return _ladder_report(spark, _run_ladder(spark, root, True))


def stream_ladder_expiry(spark: SparkSession, root: str) -> DataFrame:
    """Slices of forty days: states run out within a batch and between batches."""
    return _ladder_report(spark, _run_ladder(spark, root, True, spread=True))


def stream_ladder_state(spark: SparkSession, root: str) -> DataFrame:
    """The margin ladder in ten slices."""
    return _ladder_report(spark, _run_ladder(spark, root, False, slices=10))


def _in_order(spark: SparkSession, events: DataFrame, inbox: str, parts: int) -> None:
    """The events as files in order of time; the file source takes the oldest first."""
    day = F.floor((F.dayofmonth("ts") - 1) * parts / 31).cast("int")
    for part in range(parts):
        events.filter(day == part).coalesce(1).write.mode("append").parquet(inbox)


def stream_ladder_clock(spark: SparkSession, root: str) -> DataFrame:
    """The margin ladder with the clock: a call that stays open is escalated when its time is up, by a timer if no row comes."""
    _keyed_state(spark)
    home = work_folder(spark, "clock")
    sink = enforcement.EnforcementSink(home)
    events = tables.table(spark, root, "events")
    _in_order(spark, events, f"{home}/in", 4)
    replay = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    snapshots = tables.project_margin_events(replay.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "5 seconds"))
    _drain(lambda: enforcement.start(snapshots, sink, f"{home}/checkpoint", ONCE, clock=True))
    rows = _ladder_report(spark, sink)
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in rows.schema if f.dataType.typeName() == "timestamp"})


def backtest_stream(spark: SparkSession, root: str) -> DataFrame:
    """History replayed file by file into both ladders, counted as the batch backtest counts."""
    _keyed_state(spark)
    home = work_folder(spark, "backtest")
    events = tables.table(spark, root, "events")
    _in_order(spark, events, f"{home}/in", 6)
    out = None
    for variant, stress in (("margin", False), ("combined", True)):
        sink = enforcement.EnforcementSink(f"{home}/{variant}")
        paced = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
        _drain(lambda: enforcement.start(tables.project_margin_events(paced), sink, f"{home}/checkpoint/{variant}", ONCE, stress))  # noqa: B023
        rows = spark.read.parquet(f"{sink.path}/actions").withColumn("variant", F.lit(variant))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("variant", "event_type", "scenario").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("account_id").alias("accounts")
    )


def stream_progress(spark: SparkSession, root: str) -> DataFrame:
    """Rows that a query over three slices says it has read, and keys that its state holds at the end."""
    home = work_folder(spark, "progress")
    messages = fixtures.replay_messages(tables.table(spark, root, "events"))

    def start():
        rows = wire.read_events(spark, {"path": f"{home}/in"}, TOPIC_FILLS)
        return (
            feeds.running_positions(rows).writeStream.outputMode("update").queryName("positions")
            .option("checkpointLocation", f"{home}/checkpoint").trigger(**ONCE).format("noop").start()
        )

    for part in range(3):
        messages.filter(F.col("offset") % 3 == part).write.mode("append").parquet(f"{home}/in")
        append_progress(spark, _drain(start), f"{home}/metrics")
    batches = spark.read.parquet(f"{home}/metrics")
    return batches.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.max_by("state_rows", "batch_id").alias("state_rows")
    )


STREAMS = {
    f.__name__: f
    for f in (
        stream_fills,
        stream_prices,
        stream_betas,
        stream_late,
        stream_dedup,
        stream_dead_letters,
        stream_state,
        stream_margin_delta,
        stream_touched_accounts,
        margin_json,
        stress_json,
        stream_firm_risk,
        stream_volatility,
        stream_asof,
        stream_ladder,
        stream_ladder_combined,
        stream_ladder_expiry,
        stream_ladder_state,
        stream_ladder_clock,
        backtest_stream,
        stream_progress,
    )
}
