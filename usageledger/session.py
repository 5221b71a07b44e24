"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Aim of one shuffle partition, and bounds that keep schedulers and shuffle files sane.
SHUFFLE_BYTES = 512 * 1024**2
MIN_SHUFFLE_PARTITIONS = 200
MAX_SHUFFLE_PARTITIONS = 100_000


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # State of streaming deduplication outgrows executor heaps.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # Recording the Python call site of every column costs more than planning it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the shuffle width for an input of this size and return it.

    Spark merges partitions that turn out small but only splits those of some joins and
    writes, so the width has to follow the data: the default of 200 would make partitions
    of half a terabyte out of 100 TB. Merging stops at the advisory size instead of at
    one partition per core.
    """
    width = min(MAX_SHUFFLE_PARTITIONS, max(MIN_SHUFFLE_PARTITIONS, -(-input_bytes // SHUFFLE_BYTES)))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    return width


def pin_utc(spark: SparkSession) -> None:
    """Day boundaries are UTC everywhere, whatever zone the caller's session has."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder: there the
    driver and the executors are the same process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="usageledger-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
