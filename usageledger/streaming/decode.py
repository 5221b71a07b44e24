"""From broker records to usage events."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usageledger import schemas

# The columns a broker source delivers.
MESSAGE_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
# Bytes the schema registry puts before an Avro body.
REGISTRY_HEADER = 5
# Small caps would mean small files; with the flush interval this one bounds a batch.
MAX_BATCH_ROWS = 5_000_000
MAX_BATCH_FILES = 200


def read_broker(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_BATCH_ROWS
) -> DataFrame:
    """The topic from its beginning; needs the Kafka package on the cluster.

    A trigger takes at most `max_offsets` records, so catching up with a long log goes
    in batches. Lost offsets fail the query rather than being skipped.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )


def read_landed_messages(
    spark: SparkSession, path: str, max_files: int = MAX_BATCH_FILES, max_bytes: int | None = None
) -> DataFrame:
    """Broker records that were landed as Parquet, as a stream.

    A trigger takes at most `max_files` files or, if given, about `max_bytes` of them.
    """
    bound = ("maxFilesPerTrigger", max_files) if max_bytes is None else ("maxBytesPerTrigger", max_bytes)
    return spark.readStream.schema(MESSAGE_SCHEMA).option(*bound).parquet(path)


def avro_schema() -> str:
    """The event record as an Avro schema, from the declared columns."""
    names = {"string": "string", "bigint": "long"}
    fields = []
    for field in schemas.USAGE_EVENT.fields:
        kind = names[field.dataType.simpleString()]
        if field.name in schemas.USAGE_EVENT_REQUIRED:
            fields.append({"name": field.name, "type": kind})
        else:
            fields.append({"name": field.name, "type": ["null", kind], "default": None})
    return json.dumps({"type": "record", "name": "UsageEvent", "fields": fields})


def decode_avro(value: Column) -> Column:
    """Registry-framed Avro to a struct; needs the Avro package on the cluster."""
    from pyspark.sql.avro.functions import from_avro

    body = F.substring(value, REGISTRY_HEADER + 1, 2**31 - 1)
    return from_avro(body, avro_schema(), {"mode": "PERMISSIVE"})


def decode_json(value: Column) -> Column:
    return F.from_json(value.cast("string"), schemas.USAGE_EVENT)


def decode_messages(messages: DataFrame, decoder=decode_json) -> DataFrame:
    """Event fields, broker position, load time, and `_decoded`: are all required fields there.

    The load time is the trigger's own time, which Spark records before the batch runs,
    so a repeated batch gets the same one.
    """
    event = messages.select(
        decoder(F.col("value")).alias("event"),
        "value",
        F.col("offset").alias("_kafka_offset"),
        F.col("partition").alias("_kafka_partition"),
        F.unix_millis("timestamp").alias("_kafka_timestamp"),
        F.current_timestamp().alias("_loaded_at"),
    )
    complete = reduce(
        Column.__and__,
        [F.col(f"event.{name}").isNotNull() for name in schemas.USAGE_EVENT_REQUIRED],
    )
    return event.select(
        "event.*",
        "_kafka_offset", "_kafka_partition", "_kafka_timestamp", "_loaded_at",
        F.coalesce(complete, F.lit(False)).alias("_decoded"),
        F.when(~F.coalesce(complete, F.lit(False)), F.col("value")).alias("_undecoded"),
    )


def record_body() -> Column:
    """The event of a row as a broker value: its JSON record, with explicit NULLs."""
    record = F.struct(*schemas.USAGE_EVENT.fieldNames())
    return F.to_json(record, {"ignoreNullFields": "false"}).cast("binary")


def keyed_messages(events: DataFrame) -> DataFrame:
    """Events as broker records, keyed by account."""
    return events.select(
        F.col("account_id").cast("binary").alias("key"), record_body().alias("value")
    )


def publish_messages(events: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send an event stream to the broker, keyed by account; needs the Kafka package."""
    return (
        keyed_messages(events).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def progress_offsets(spark: SparkSession, progress: dict) -> DataFrame:
    """Offsets per topic and partition from a broker query's `lastProgress`.

    One row per partition of the subscribed topics, in the columns `quality.lag_status`
    expects.
    """
    rows = []
    for source in progress["sources"]:
        done, newest = (_offsets(source.get(name)) for name in ("endOffset", "latestOffset"))
        for topic, partitions in newest.items():
            for partition, offset in partitions.items():
                rows.append((topic, int(partition), offset, done.get(topic, {}).get(partition, 0)))
    return spark.createDataFrame(
        rows, "topic string, partition int, log_end_offset bigint, current_offset bigint"
    )


def _offsets(reported: str | dict | None) -> dict:
    return json.loads(reported) if isinstance(reported, str) else reported or {}
