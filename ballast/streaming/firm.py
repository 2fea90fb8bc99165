"""Firm totals on a stream of account totals: per bucket of accounts, then over buckets.

Both levels retract: a bucket keeps what each of its accounts last had and moves its sums by the difference, the firm keeps
what each bucket last had. An alert comes only when the exposure crosses the limit, not for every batch above it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ballast.params import DEFAULT, RiskParams
from ballast.streaming.blocks import Blocks, joined

BUCKETS = 64
BUCKET = "bucket INT, version BIGINT, exposure DOUBLE, value DOUBLE, accounts BIGINT"
ACCOUNTS = pa.schema([("account_id", pa.string()), ("batch", pa.int64()), ("exposure", pa.float64()), ("value", pa.float64())])
FIRM = "firm_beta_weighted_exposure DOUBLE, firm_total_mv DOUBLE, num_accounts BIGINT, limit_breached BOOLEAN, crossed STRING, version BIGINT"


class BucketProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accounts = Blocks(handle, "accounts", ACCOUNTS)
        self.sums = handle.getValueState("sums", "version BIGINT, exposure DOUBLE, value DOUBLE, accounts BIGINT")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        was = self.accounts.read().to_pandas()
        # of an account's rows the one of the highest batch, of these the last
        newest = pd.concat([was, joined(rows)[ACCOUNTS.names]], ignore_index=True).sort_values("batch", kind="stable").drop_duplicates("account_id", keep="last")
        version, exposure, value, accounts = self.sums.get() or (0, 0.0, 0.0, 0)
        exposure += float(newest["exposure"].sum() - was["exposure"].sum())
        value += float(newest["value"].sum() - was["value"].sum())
        accounts += len(newest) - len(was)
        self.accounts.write(pa.Table.from_pandas(newest, ACCOUNTS, preserve_index=False))
        self.sums.update((version + 1, exposure, value, accounts))
        yield pd.DataFrame([(key[0], version + 1, exposure, value, accounts)], columns=[c.split()[0] for c in BUCKET.split(", ")])


class FirmProcessor(StatefulProcessor):
    def __init__(self, limit: float) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buckets = handle.getMapState("buckets", "bucket INT", "version BIGINT, exposure DOUBLE, value DOUBLE, accounts BIGINT")
        self.above = handle.getValueState("above", "above BOOLEAN, version BIGINT")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            for bucket, *now in zip(*(chunk[c.split()[0]].tolist() for c in BUCKET.split(", ")), strict=True):
                was = self.buckets.getValue((bucket,)) if self.buckets.containsKey((bucket,)) else None
                if was is None or was[0] < now[0]:
                    self.buckets.updateValue((bucket,), tuple(now))
        known = [v for _, v in self.buckets.iterator()]  # as many as there are buckets
        exposure, value, accounts = (sum(v[k] for v in known) for k in (1, 2, 3))
        was, version = self.above.get() if self.above.exists() else (False, 0)
        now = exposure > self.limit
        self.above.update((now, version + 1))
        crossed = None if now == was else "ABOVE" if now else "BELOW"
        yield pd.DataFrame([(exposure, value, accounts, now, crossed, version + 1)], columns=[c.split()[0] for c in FIRM.split(", ")])


def bucket_totals(totals: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Sums per bucket that a micro-batch of account totals (account_id, total_mv, beta_weighted_exposure, batch) changes.

    Of an account's rows the one of the highest batch counts, in whatever order they come.
    """
    rows = totals.select(
        F.pmod(F.xxhash64("account_id"), F.lit(buckets)).cast("int").alias("bucket"), F.col("account_id").cast("string").alias("account_id"),
        F.col("batch").cast("bigint").alias("batch"), F.coalesce("beta_weighted_exposure", F.lit(0.0)).alias("exposure"), F.coalesce("total_mv", F.lit(0.0)).alias("value"),
    )
    return rows.filter("account_id IS NOT NULL").groupBy("bucket").transformWithStateInPandas(BucketProcessor(), BUCKET, "Append", "None")


def firm_risk(buckets: DataFrame, params: RiskParams = DEFAULT) -> DataFrame:
    """The firm's totals after each micro-batch of bucket sums; ``crossed`` says when the exposure passes the limit."""
    one = buckets.withColumn("firm", F.lit("firm"))
    return one.groupBy("firm").transformWithStateInPandas(FirmProcessor(params.firm_limit), FIRM, "Append", "None")


def alerts(firm: DataFrame) -> DataFrame:
    return firm.filter("crossed IS NOT NULL")


def start(totals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, params: RiskParams = DEFAULT, buckets: int = BUCKETS) -> list:
    """Start both levels below ``path``; a trigger that ends by itself drains the first before the second begins."""
    spark: SparkSession = totals.sparkSession

    def write(rows: DataFrame, name: str):
        out = rows.writeStream.option("checkpointLocation", f"{checkpoint}/{name}").trigger(**(trigger or {"processingTime": "5 seconds"}))
        return out.queryName(f"firm_{name}").format("parquet").start(f"{path}/{name}")

    first = write(bucket_totals(totals, buckets), "buckets")
    if trigger and ("availableNow" in trigger or "once" in trigger):
        first.awaitTermination()
    return [first, write(firm_risk(spark.readStream.schema(BUCKET).parquet(f"{path}/buckets"), params), "firm")]
