"""File sources: price history in CSV, the partitioned audit log."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.schemas import AUDIT, AUDIT_PARTITIONS, HISTORY_CSV


def price_history(spark: SparkSession, path: str) -> DataFrame:
    """Price history (timestamp, symbol, price) in time order, for replay."""
    return spark.read.schema(HISTORY_CSV).csv(path, header=True).orderBy("timestamp", "symbol", "price")


def price_history_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The same as a stream whose pace is set by files per trigger."""
    return (
        spark.readStream.schema(HISTORY_CSV)
        .option("header", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(path)
    )


def audit_log(spark: SparkSession, path: str, account_type: str = "STRING") -> DataFrame:
    """Audit log; filters on year, month, day and hour prune folders."""
    body = AUDIT.replace("account_id STRING", f"account_id {account_type}")
    return spark.read.schema(f"{body}, {AUDIT_PARTITIONS}").json(path)


def audit_day(log: DataFrame, year: int, month: int, day: int | None = None) -> DataFrame:
    wanted = (F.col("year") == year) & (F.col("month") == month)
    return log.filter(wanted if day is None else wanted & (F.col("day") == day))


def _hours_since(at: Column) -> Column:
    """Year, month, day and hour of a row's folder at or after those of ``at``, in a form that prunes folders."""
    own = [F.col(c) for c in ("year", "month", "day", "hour")]
    bound = [F.year(at), F.month(at), F.dayofmonth(at), F.hour(at)]
    later = own[3] >= bound[3]
    for mine, its in zip(own[2::-1], bound[2::-1], strict=True):
        later = (mine > its) | ((mine == its) & later)
    return later


def audit_since(log: DataFrame, at: datetime) -> DataFrame:
    """Rows of the audit log after ``at``; only folders of its hour and later are read."""
    when = F.lit(at).cast("timestamp_ntz")
    return log.filter(_hours_since(when) & (F.col("timestamp") > when))


def drop_expired(spark: SparkSession, path: str, before: datetime) -> list[str]:
    """Delete the hour folders of an audit log that end at or before ``before``; their names, in order.

    Goes by the names of folders alone: no file is read or rewritten.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for found in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*/day=*/hour=*")) or []:
        folder = found.getPath().toString()
        year, month, day, hour = (int(part.partition("=")[2]) for part in folder.rsplit("/", 4)[1:])
        if datetime(year, month, day, hour) + timedelta(hours=1) <= before and fs.delete(found.getPath(), True):
            gone.append("/".join(folder.rsplit("/", 4)[1:]))
    return sorted(gone)
