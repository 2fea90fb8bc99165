"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="ballast-")


def shared_folder(spark: SparkSession) -> str:
    """Root the cluster names in spark.checkpoint.dir; a temporary one only in local mode."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # a local cluster has executors of its own
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return _local_root()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run below the shared root."""
    return f"{shared_folder(spark)}/ballast/{purpose}-{uuid.uuid4().hex}"
