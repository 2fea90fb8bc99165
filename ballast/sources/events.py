"""Event topics: reading, decoding, routing, dead letters.

A message frame has the columns of Spark's Kafka source that we use: topic,
key, value, offset, timestamp. Files of such rows stand in for a broker in
tests; both come through ``read_messages``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ballast import params as p
from ballast.params import DEFAULT, TOPIC_BETAS, TOPIC_FILLS, TOPIC_PRICES
from ballast.schemas import BY_TOPIC

MESSAGE = "topic STRING, key STRING, value STRING, offset BIGINT, timestamp TIMESTAMP"
CORRUPT = "_corrupt"

# what a usable message of a topic must carry; a fill without price still moves a position
REQUIRED = {
    TOPIC_FILLS: ("account_id", "symbol", "qty", "timestamp"),
    TOPIC_PRICES: ("symbol", "price", "timestamp"),
    TOPIC_BETAS: ("symbol", "beta", "timestamp"),
    p.TOPIC_MARGIN: ("account_id",),
    p.TOPIC_STRESS: ("account_id", "scenario"),
    p.TOPIC_CALLS: ("account_id", "action"),
    p.TOPIC_RESTRICTIONS: ("account_id", "action"),
    p.TOPIC_LIQUIDATIONS: ("account_id",),
    p.TOPIC_AUDIT: ("event_id", "event_type"),
}


def read_messages(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Messages from Kafka (``kafka.bootstrap.servers``, ``subscribe``, ...) or from files (``path``)."""
    options = dict(options)
    reader = spark.readStream if streaming else spark.read
    if "path" in options:
        path = options.pop("path")
        return reader.schema(MESSAGE).options(**options).format("parquet").load(path)
    options.setdefault("startingOffsets", "latest" if streaming else "earliest")
    return (
        reader.format("kafka")
        .options(**options)
        .load()
        .select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "offset",
            "timestamp",
        )
    )


def _fields(topic: str) -> T.StructType:
    return T._parse_datatype_string(f"{BY_TOPIC[topic]}, {CORRUPT} STRING")


def parsed(topic: str) -> Column:
    """The value as the topic's fields. A missing field or one of the wrong type is NULL; the latter fills CORRUPT too."""
    return F.from_json("value", _fields(topic), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def fault(topic: str, field: Callable[[str], Column]) -> Column:
    """Why a message of a known topic cannot be used, or NULL. Usable rows and dead letters both follow from this.

    ``field`` gives a field of the parsed value. A text that is no JSON object leaves all fields NULL and CORRUPT filled.
    """
    lacking = reduce(lambda x, y: x | y, [field(name).isNull() for name in REQUIRED[topic]])
    nothing = reduce(lambda x, y: x & y, [field(f.name).isNull() for f in _fields(topic) if f.name != CORRUPT])
    odd = field(CORRUPT).isNotNull()
    return (
        F.when(F.col("value").isNull() | (odd & nothing), "MALFORMED")
        .when(lacking, "MISSING_FIELD")
        .when(odd, "MISTYPED_FIELD")
    )


def usable_rows(messages: DataFrame, topic: str) -> DataFrame:
    """Decoded rows of one topic that carry all they need, beside ``ts`` (time of the record) and ``seq`` (its offset).

    The fields come out of a generator, which parses a message once; as a plain column the parser would be copied into
    the filter once for each field that is asked for.
    """
    names = [f.name for f in _fields(topic)]
    own = messages.filter(F.col("topic") == topic).select(
        F.col("timestamp").alias("ts"), F.col("offset").alias("seq"), "value", F.inline(F.array(parsed(topic))).alias(*[f"_{n}" for n in names])
    )
    good = own.filter(fault(topic, lambda name: F.col(f"_{name}")).isNull())
    return good.select("ts", "seq", *[F.col(f"_{n}").alias(n) for n in names if n != CORRUPT])


def read_events(
    spark: SparkSession,
    options: dict[str, str],
    topic: str,
    watermark: str | None = DEFAULT.watermark,
    streaming: bool = True,
) -> DataFrame:
    """Usable rows of one topic with event time, watermarked when streaming."""
    rows = usable_rows(read_messages(spark, options, streaming), topic)
    return rows.withWatermark("ts", watermark) if streaming and watermark else rows


def routed(messages: DataFrame) -> DataFrame:
    """Add ``route``: the topic when there is a handler for it, else dead letters."""
    return messages.withColumn("route", F.when(F.col("topic").isin(*BY_TOPIC), F.col("topic")).otherwise("dead"))


def _why(topic: str) -> Column:
    """The fault of a message of a topic; as the variable of a lambda, the parsed value is made once."""
    return F.transform(F.array(parsed(topic)), lambda data: fault(topic, lambda name: data[name]))[0]


def dead_letters(messages: DataFrame) -> DataFrame:
    """Messages nobody can process, with the reason. One pass over the messages, batch or stream."""
    reason = F.when(F.col("topic").isNull() | ~F.col("topic").isin(*BY_TOPIC), "UNKNOWN_TOPIC")
    for topic in BY_TOPIC:
        reason = reason.when(F.col("topic") == topic, _why(topic))
    return messages.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def write_dead_letters(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start the query that keeps a stream's dead letters as files, beside the queries on its topics."""
    return (
        dead_letters(messages)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .queryName("dead_letters")
        .format("parquet")
        .start(path)
    )
