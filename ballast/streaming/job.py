"""The whole job: every query from wire topics to results, as starters for the supervisor.

    wire -> fill ids on record, much later fills, dead letters
    wire + much later fills -> positions -> margin, index stress, grid -> enforcement; firm totals per bucket -> firm
    wire -> volatility

Queries meet in folders below ``home``, each with its own checkpoint, so any of them can end and go on alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ballast.params import DEFAULT, TOPIC_BETAS, TOPIC_FILLS, TOPIC_FIRM, TOPIC_MARGIN, TOPIC_PRICES, TOPIC_VOLATILITY, RiskParams
from ballast.schemas import FILLS, MARGIN
from ballast.sinks.events import to_messages
from ballast.sources import events as wire
from ballast.streaming import enforcement, feeds, firm, history, margin, positions

FOLDERS = ("record", "late/fills", "deltas", "margin/totals", "margin/out", "firm/buckets")


def snapshots(messages: DataFrame) -> DataFrame:
    """Margin messages (topic, value) as the snapshots that the ladder takes."""
    rows = messages.filter(F.col("topic") == TOPIC_MARGIN).select(F.from_json("value", MARGIN).alias("m")).select("m.*")
    at = F.timestamp_millis("calc_timestamp")
    return rows.filter("account_id IS NOT NULL").select(
        "account_id", at.alias("ts"), F.xxhash64("account_id", "calc_timestamp").alias("event_id"),
        "excess", "equity", "total_mv", "maintenance_req", "beta_weighted_exposure",
    )


def starters(
    spark: SparkSession,
    source: dict[str, str],
    home: str,
    trigger: dict | None = None,
    params: RiskParams = DEFAULT,
    cash: DataFrame | None = None,
    slices: int = positions.SLICES,
    buckets: int = firm.BUCKETS,
    horizon: str = feeds.HORIZON,
) -> dict[str, Callable[[], StreamingQuery]]:
    """Functions that start each query of the job, by name, upstream ones first. `source`: options of `read_messages`."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for name in FOLDERS:  # a stream takes only folders that are there
        path = hadoop(f"{home}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    checkpoint = lambda name: f"{home}/checkpoint/{name}"

    def rows(topic: str) -> DataFrame:
        return wire.read_events(spark, source, topic, watermark=None)

    def fills() -> DataFrame:
        """The broker's time is that of arrival, the wire's that of the event."""
        return rows(TOPIC_FILLS).withColumn("arrived", F.col("ts")).withColumn("ts", F.timestamp_millis("timestamp"))

    def unique() -> DataFrame:
        names = ["ts", "seq", "arrived", *(c.split()[0] for c in FILLS.split(", "))]
        schema = f"ts TIMESTAMP, seq BIGINT, arrived TIMESTAMP, {FILLS}"
        late = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{home}/late/fills")
        return feeds.dedup(fills(), horizon).select(*names).unionByName(late.select(*names))

    def read(schema: str, path: str) -> DataFrame:
        return spark.readStream.schema(schema).parquet(f"{home}/{path}")

    def messages(changed: DataFrame, key: str, topic: str, name: str, mode: str) -> StreamingQuery:
        """Rows as messages of a topic, a folder per batch."""
        out = to_messages(changed, key, topic).writeStream.outputMode(mode).option("checkpointLocation", checkpoint(name))
        return out.trigger(**(trigger or {"processingTime": "5 seconds"})).queryName(name).foreachBatch(feeds.changelog(f"{home}/{name}")).start()

    def start_positions() -> StreamingQuery:
        laid = positions.laid(unique(), rows(TOPIC_PRICES), rows(TOPIC_BETAS), slices)
        return positions.start(laid, f"{home}/deltas", checkpoint("positions"), trigger, params)

    def start_buckets() -> StreamingQuery:
        sums = firm.bucket_totals(read(f"{margin.TOTALS}, batch BIGINT", "margin/totals"), buckets)
        out = sums.writeStream.option("checkpointLocation", checkpoint("firm_buckets")).trigger(**(trigger or {"processingTime": "5 seconds"}))
        return out.queryName("firm_buckets").format("parquet").start(f"{home}/firm/buckets")

    return {
        "fill_ids": lambda: feeds.start_record(fills(), f"{home}/record", checkpoint("fill_ids"), trigger, horizon),
        "late_fills": lambda: feeds.start_late(fills(), feeds.LateFills(f"{home}/record", f"{home}/late"), checkpoint("late_fills"), trigger, horizon),
        "dead_letters": lambda: wire.write_dead_letters(wire.read_messages(spark, source), f"{home}/dead", checkpoint("dead_letters"), trigger),
        "positions": start_positions,
        "margin": lambda: margin.start(positions.read_deltas(spark, f"{home}/deltas"), margin.MarginSink(f"{home}/margin", cash, params), checkpoint("margin"), trigger),
        "enforcement": lambda: enforcement.start(
            snapshots(read("key STRING, value STRING, batch BIGINT, topic STRING", "margin/out")),
            enforcement.EnforcementSink(f"{home}/enforcement", params), checkpoint("enforcement"), trigger,
        ),
        "volatility": lambda: messages(history.latest_volatility(rows(TOPIC_PRICES), params), "symbol", TOPIC_VOLATILITY, "volatility", "update"),
        "firm_buckets": start_buckets,
        "firm": lambda: messages(
            firm.firm_risk(read(firm.BUCKET, "firm/buckets"), params).withColumn("firm", F.lit("firm")), "firm", TOPIC_FIRM, "firm_risk", "append"
        ),
    }
