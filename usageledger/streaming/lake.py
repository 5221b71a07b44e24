"""Streaming sinks: the hour-partitioned event lake and the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usageledger import fixed_values as fv
from usageledger.functions.columns import hour_parts
from usageledger.schemas import USAGE_EVENT
from usageledger.session import pin_utc

EVENT_COLUMNS = USAGE_EVENT.fieldNames()
LAKE_COLUMNS = [*EVENT_COLUMNS, "_kafka_offset", "_kafka_partition", "_kafka_timestamp", "_loaded_at"]
RAW_COLUMNS = [c for c in LAKE_COLUMNS if c != "_kafka_timestamp"]
QUARANTINE_COLUMNS = ["_undecoded", "_kafka_offset", "_kafka_partition", "_kafka_timestamp", "_loaded_at"]

MANIFEST = (
    "batch bigint, record_count bigint, min_event_timestamp bigint, max_event_timestamp bigint, "
    "uploaded_at bigint"
)


def _write_batch(rows: DataFrame, path: str, folders: list[str]) -> None:
    """Replace exactly the folders of this batch, so a repeated batch leaves no copies."""
    rows.write.partitionBy(*folders).option("partitionOverwriteMode", "dynamic").mode(
        "overwrite"
    ).parquet(path)


def _land(path: str, columns: list[str], quarantine: bool, manifest: bool, by_hour: bool):
    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # A trigger's rows are bounded by its source limit; both outputs read them.
        held = batch.persist()
        try:
            seen = Observation()
            good = held.where("_decoded").select(*columns)
            parts = hour_parts("_loaded_at") if by_hour else {"load_date": F.to_date("_loaded_at")}
            folders = [*parts, "batch"]
            good = good.withColumns(parts)
            good = good.withColumn("batch", F.lit(batch_id)).observe(
                seen,
                F.count(F.lit(1)).alias("record_count"),
                F.min("event_timestamp").alias("min_event_timestamp"),
                F.max("event_timestamp").alias("max_event_timestamp"),
                F.unix_micros(F.max("_loaded_at")).alias("uploaded_at"),
            )
            _write_batch(good, f"{path}/events", folders)
            if manifest and seen.get["record_count"]:
                line = spark.createDataFrame([(batch_id, *seen.get.values())], MANIFEST).withColumn(
                    "uploaded_at", F.timestamp_micros("uploaded_at")
                )
                _write_batch(line, f"{path}/_batches", ["batch"])
            if quarantine:
                bad = held.where("NOT _decoded").select(*QUARANTINE_COLUMNS)
                _write_batch(bad.withColumn("batch", F.lit(batch_id)), f"{path}/_undecoded", ["batch"])
        finally:
            held.unpersist()

    return land


def _start(decoded: DataFrame, land, checkpoint: str, seconds: int | None) -> StreamingQuery:
    pin_utc(decoded.sparkSession)
    writer = decoded.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def events_to_lake(
    decoded: DataFrame, path: str, checkpoint: str, seconds: int | None = fv.FLUSH_SECONDS
) -> StreamingQuery:
    """Write decoded events to `path/events/year=/month=/day=/hour=/batch=`.

    `path/_batches` gets one row per batch with its count and time range, taken during
    the write; `path/_undecoded` the records that did not decode. Spark commits the
    source position after the batch function returns, and a repeated batch replaces its
    own folders. `seconds=None` drains what is there and stops.
    """
    land = _land(path, LAKE_COLUMNS, quarantine=True, manifest=True, by_hour=True)
    return _start(decoded, land, checkpoint, seconds)


def events_to_raw(
    decoded: DataFrame, path: str, checkpoint: str, seconds: int | None = fv.FLUSH_SECONDS
) -> StreamingQuery:
    """Write decoded events to `path/events/load_date=/batch=`, without the broker's timestamp."""
    land = _land(path, RAW_COLUMNS, quarantine=True, manifest=False, by_hour=False)
    return _start(decoded, land, checkpoint, seconds)


def drop_redelivered(decoded: DataFrame) -> DataFrame:
    """Drop every further copy of an event, however late either of them is.

    A watermark on the event time would drop late events together with late copies, so
    there is none: the state holds each event id once, for as long as the query lives.
    Sessions from `build_session` keep it in RocksDB. Where that is too much, land all
    copies and deduplicate in batch with `keep_latest`.
    """
    timed = decoded.withColumn("event_time", F.timestamp_millis("event_timestamp"))
    return timed.dropDuplicates(["event_id"])


def drop_redelivered_within(decoded: DataFrame, horizon: str, arrival: str = "_kafka_timestamp") -> DataFrame:
    """Drop further copies of an event that arrive within `horizon` of the first, with bounded state.

    The watermark is on the arrival, which does not go back in a broker's log, and not on the
    event time: an event that happened long ago is kept. An id leaves the state once the horizon
    has passed, so a copy that a producer sends again later than that stays and is left to
    `keep_latest` in the batch layer. A record whose arrival lies behind all others by more than the
    horizon is dropped; choose it above the time that brokers' clocks and partitions differ by.
    """
    timed = decoded.withColumn("_arrived", F.timestamp_millis(arrival)).withWatermark("_arrived", horizon)
    return timed.dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived")
