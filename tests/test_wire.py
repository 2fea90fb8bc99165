"""Decoding, routing, dead letters, sinks, replay."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ballast.operators import audit
from ballast.params import (
    TOPIC_AUDIT,
    TOPIC_BETAS,
    TOPIC_FILLS,
    TOPIC_FIRM,
    TOPIC_MARGIN,
    TOPIC_ORDERS,
    TOPIC_PRICES,
    TOPIC_VOLATILITY,
    TOPICS,
)
from ballast.plans import catalog
from ballast.schemas import BY_TOPIC
from ballast.session import shared_folder, work_folder
from ballast.sinks import events as sinks
from ballast.sources import events as wire
from ballast.sources import files, tables
from tests.conftest import SF, rows

AT = datetime(2024, 1, 1, 9, 30, 0, 123000)


def messages(spark, *items):
    return spark.createDataFrame(
        [(topic, "k", value, n, AT) for n, (topic, value) in enumerate(items)], wire.MESSAGE
    )


GOOD = '{"account_id":"a","symbol":"X","qty":-5,"price":1.5,"timestamp":7,"fill_id":"f"}'


def test_usable_rows_and_dead_letters_are_the_two_halves(spark):
    sent = messages(
        spark,
        (TOPIC_FILLS, GOOD),
        (TOPIC_FILLS, GOOD[:-1]),
        (TOPIC_FILLS, None),
        (TOPIC_FILLS, GOOD.replace("-5", '"many"')),
        (TOPIC_PRICES, '{"symbol":"X","price":2.0,"timestamp":7}'),
        (TOPIC_PRICES, '{"symbol":"X","timestamp":7}'),
        (TOPIC_BETAS, '{"symbol":"X","beta":2.0,"timestamp":7}'),
        ("nobody.v1", "{}"),
        (TOPIC_FILLS, GOOD.replace("1.5", '"n/a"')),
        (TOPIC_MARGIN, '{"account_id":"a","equity":1.0'),
        (None, GOOD),
        (TOPIC_MARGIN, '{"account_id":"a","equity":1.0}'),
        (TOPIC_AUDIT, '{"event_type":"x"}'),
        (TOPIC_FILLS, GOOD.replace(',"price":1.5', "")),
        (TOPIC_FILLS, "not json"),
    )
    dead = {r.offset: r.reason for r in wire.dead_letters(sent).collect()}
    assert dead == {
        1: "MALFORMED", 2: "MALFORMED", 3: "MISSING_FIELD", 5: "MISSING_FIELD", 7: "UNKNOWN_TOPIC", 8: "MISTYPED_FIELD",
        9: "MALFORMED", 10: "UNKNOWN_TOPIC", 12: "MISSING_FIELD", 14: "MALFORMED",
    }
    alive = [r.seq for t in BY_TOPIC for r in wire.usable_rows(sent, t).collect()]
    assert sorted([*alive, *dead]) == list(range(15))
    assert wire.usable_rows(sent, TOPIC_FILLS).filter("seq = 13").first().price is None


def test_every_topic_has_a_schema(spark):
    assert set(TOPICS) == set(BY_TOPIC)
    sent = messages(spark, *[(t, "{}") for t in TOPICS], ("x", "{}"))
    routes = {r.topic: r.route for r in wire.routed(sent).collect()}
    assert routes.pop("x") == "dead" and all(k == v for k, v in routes.items())
    for topic, ddl in BY_TOPIC.items():
        assert set(wire.REQUIRED[topic]) <= {f.split()[0] for f in ddl.split(", ")}


def test_messages_round_trip(spark):
    folder = work_folder(spark, "test")
    fills = spark.createDataFrame([("a", "X", 3, 1.25), ("b", "Y", -1, None)], "account_id STRING, symbol STRING, qty INT, price DOUBLE")
    sinks.write_events(fills, {"path": folder}, "account_id", TOPIC_FILLS)
    back = spark.read.json(folder).withColumn("data", F.from_json("value", BY_TOPIC[TOPIC_FILLS]))
    assert rows(back.select("topic", "key", "data.account_id", "data.qty", "data.price")) == [
        (TOPIC_FILLS, "a", "a", 3, 1.25),
        (TOPIC_FILLS, "b", "b", -1, None),
    ]


def test_house_topics_share_the_writer(spark):
    folder = work_folder(spark, "test")
    sinks.write_events(catalog.latest_volatility(spark, SF), {"path": folder}, "symbol", TOPIC_VOLATILITY)
    risk = catalog.firm_stress(spark, SF)
    sinks.write_events(risk, {"path": folder}, "scenario", TOPIC_FIRM)
    sinks.write_events(catalog.liquidation_orders(spark, SF), {"path": folder}, "account_id", TOPIC_ORDERS)
    got = {r.topic: r["count"] for r in spark.read.json(folder).groupBy("topic").count().collect()}
    assert got == {TOPIC_VOLATILITY: 200, TOPIC_FIRM: 8, TOPIC_ORDERS: catalog.liquidation_orders(spark, SF).count()}


def test_audit_log_prunes_folders(spark):
    folder = work_folder(spark, "test")
    log = audit.audit_events(catalog.actions(spark, SF))
    sinks.write_audit(log, folder)
    stored = files.audit_log(spark, folder, "BIGINT")
    assert stored.count() == log.count()
    day = files.audit_day(stored, 2024, 1, 16)
    text = day._jdf.queryExecution().executedPlan().toString()
    assert "day" in text.split("PartitionFilters: [")[1].split("]")[0]
    want = log.filter(F.to_date("timestamp") == F.lit("2024-01-16").cast("date")).count()
    assert day.count() == want > 0
    assert rows(day.select("event_id", "details.deficiency")) == rows(
        log.filter(F.to_date("timestamp") == F.lit("2024-01-16").cast("date")).select("event_id", "details.deficiency")
    )


def test_state_appends(spark):
    folder = work_folder(spark, "test")
    history = catalog.state_rows(spark, SF)
    sinks.write_state(history.filter("status = 'WARNING'"), folder)
    sinks.write_state(history.filter("status <> 'WARNING'"), folder)
    from ballast.operators.ladder import latest_state

    assert rows(latest_state(spark.read.parquet(folder))) == rows(latest_state(history))


def test_price_history_as_stream(spark):
    folder = work_folder(spark, "test")
    ticks = tables.prices(spark, SF).select(F.col("ts").alias("timestamp"), F.col("symbol").cast("string").alias("symbol"), "price")
    ticks.repartition(3).write.csv(f"{folder}/in", header=True)
    query = (
        files.price_history_stream(spark, f"{folder}/in")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/c")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    assert len(query.recentProgress) == 3
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(files.price_history(spark, f"{folder}/in"))


def test_display_lines(spark):
    def line(kind, ddl, *values):
        df = spark.createDataFrame([(AT, *values)], f"ts TIMESTAMP, {ddl}")
        return df.select(sinks.display_line(kind, df)).first()[0]

    assert line("fill", "account_id STRING, qty INT, symbol STRING, price DOUBLE", "a", 5, "X", 2.005) == "09:30:00.123 fill account_id=a symbol=X qty=5 price=2.01"
    assert line("price", "symbol STRING, price DOUBLE", "X", None) == "09:30:00.123 price symbol=X price=-"
    assert line("stress", "account_id STRING, scenario DOUBLE, underwater BOOLEAN", "a", -0.08, False).endswith(" stress account_id=a scenario=-0.08 underwater=false")
    assert line("restriction", "account_id STRING, action STRING, reason STRING", "a", "CLOSE_ONLY", None).endswith(" action=CLOSE_ONLY reason=-")


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        wire.read_messages(spark, {"kafka.bootstrap.servers": "nowhere:9092", "subscribe": ",".join(TOPICS)})


def test_retention_reads_live_folders_and_drops_the_others(spark):
    folder = work_folder(spark, "test")
    days = [datetime(2024, 1, 9, 22, 59), datetime(2024, 1, 9, 23, 5), datetime(2024, 1, 10, 0, 5), datetime(2024, 1, 10, 0, 45), datetime(2024, 2, 1, 3)]
    trail = spark.createDataFrame([(f"e{n}", at) for n, at in enumerate(days)], "event_id STRING, timestamp TIMESTAMP_NTZ")
    sinks.write_audit(trail, folder)
    log = files.audit_log(spark, folder)
    at = datetime(2024, 1, 10, 0, 30)
    live = files.audit_since(log, at)
    assert sorted(r.event_id for r in live.collect()) == ["e3", "e4"]
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    read = live.select(F.input_file_name().alias("f")).distinct().collect()
    assert not any("day=09" in r.f for r in read)
    assert files.drop_expired(spark, folder, at) == ["year=2024/month=01/day=09/hour=22", "year=2024/month=01/day=09/hour=23"]
    assert sorted(r.event_id for r in files.audit_log(spark, folder).collect()) == ["e2", "e3", "e4"]
    assert files.drop_expired(spark, folder, at) == []
