import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from compare import plan_text
from usageledger import schemas
from usageledger.plans import quality, usage
from usageledger.sources.tables import loaded_between, read_events
from usageledger.streaming import decode, lake

HOUR_MS = 3_600_000
START_MS = 1_704_067_200_000


def messages(spark, first, count, broken=()):
    rows = []
    for n in range(first, first + count):
        event = {
            "event_id": f"evt_{n}", "account_id": f"acc_{n % 3}", "user_id": f"u{n % 5}", "event_type": "login",
            "feature_name": None, "session_id": f"s{n % 7}", "event_timestamp": START_MS + n * HOUR_MS, "metadata": "{}",
        }
        body = "{nonsense" if n in broken else json.dumps(event)
        rows.append((b"k", body.encode(), "t", n % 6, n, datetime(2024, 1, 1, 1)))
    return spark.createDataFrame(rows, decode.MESSAGE_SCHEMA)


def drain(spark, tmp_path, sink=lake.events_to_lake, **options):
    stream = decode.decode_messages(decode.read_landed_messages(spark, str(tmp_path / "in"), **options))
    sink(stream, str(tmp_path / "lake"), str(tmp_path / "ckpt"), None).awaitTermination()
    return str(tmp_path / "lake")


def land(spark, tmp_path, *args, **kwargs):
    messages(spark, *args, **kwargs).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_lake_layout_quarantine_and_manifest(spark, tmp_path):
    land(spark, tmp_path, 0, 20, broken={3, 4})
    path = drain(spark, tmp_path)
    events = spark.read.parquet(f"{path}/events")
    assert events.columns == [*lake.LAKE_COLUMNS, "year", "month", "day", "hour", "batch"]
    assert events.count() == 18
    stamp = events.select("_loaded_at").first()[0]
    folder = f"year={stamp:%Y}/month={stamp:%m}/day={stamp:%d}/hour={stamp:%H}/batch=0"
    assert (tmp_path / "lake" / "events" / folder).is_dir()
    bad = spark.read.parquet(f"{path}/_undecoded").orderBy("_kafka_offset").collect()
    assert [(bytes(r._undecoded), r._kafka_offset) for r in bad] == [(b"{nonsense", 3), (b"{nonsense", 4)]
    line, = spark.read.parquet(f"{path}/_batches").collect()
    assert (line.batch, line.record_count) == (0, 18)
    assert (line.min_event_timestamp, line.max_event_timestamp) == (START_MS, START_MS + 19 * HOUR_MS)
    assert line.uploaded_at == stamp


def test_restart_continues_where_it_stopped(spark, tmp_path):
    land(spark, tmp_path, 0, 5)
    drain(spark, tmp_path)
    land(spark, tmp_path, 5, 4)
    path = drain(spark, tmp_path)
    drain(spark, tmp_path)
    events = spark.read.parquet(f"{path}/events")
    assert sorted(r._kafka_offset for r in events.collect()) == list(range(9))
    assert [r.record_count for r in spark.read.parquet(f"{path}/_batches").orderBy("batch").collect()] == [5, 4]


def test_a_repeated_batch_leaves_no_copies(spark, tmp_path):
    path = str(tmp_path / "lake")
    decoded = decode.decode_messages(messages(spark, 0, 6, broken={1}))
    decoded = spark.createDataFrame(decoded.collect(), decoded.schema)
    write = lake._land(path, lake.LAKE_COLUMNS, quarantine=True, manifest=True, by_hour=True)
    for _ in range(3):
        write(decoded, 7)
    assert spark.read.parquet(f"{path}/events").count() == 5
    assert spark.read.parquet(f"{path}/_undecoded").count() == 1
    assert spark.read.parquet(f"{path}/_batches").count() == 1


def test_files_per_trigger_bound_the_batches(spark, tmp_path):
    for first in (0, 3, 6):
        land(spark, tmp_path, first, 3)
    path = drain(spark, tmp_path, max_files=1)
    assert [r.record_count for r in spark.read.parquet(f"{path}/_batches").collect()] == [3, 3, 3]


def test_raw_table_feeds_the_daily_metrics(spark, tmp_path):
    land(spark, tmp_path, 0, 30)
    land(spark, tmp_path, 10, 5)  # delivered twice
    path = drain(spark, tmp_path, lake.events_to_raw)
    raw = spark.read.parquet(f"{path}/events")
    assert raw.count() == 35 and "_kafka_timestamp" not in raw.columns
    batch = decode.decode_messages(messages(spark, 0, 30)).select(*lake.RAW_COLUMNS)
    drop = ["_processed_at"]
    assertDataFrameEqual(usage.usage_daily(raw).drop(*drop), usage.usage_daily(batch).drop(*drop))


def test_lake_scan_opens_only_wanted_folders(spark, tmp_path):
    land(spark, tmp_path, 0, 8)
    path = drain(spark, tmp_path)
    events = read_events(spark, f"{path}/events")
    day = events.select("load_date").first()[0]
    today = loaded_between(events, day, day)
    assert today.count() == 8
    filters = plan_text(today).split("PartitionFilters: ")[1]
    assert "make_date(year" in filters
    # the daily job reads the lake as it is
    target = str(tmp_path / "daily")
    usage.run_usage_daily(spark, f"{path}/events", target, day, loaded_since=day)
    assert spark.read.parquet(target).agg(F.sum("event_count")).first()[0] == 8


def test_incomplete_records_do_not_decode(spark):
    rows = spark.createDataFrame(
        [(json.dumps({"event_id": "e"}).encode(),), (None,), (b"[]",)], "value binary"
    ).selectExpr("cast(null as binary) key", "value", "'t' topic", "0 partition", "cast(1 as bigint) offset", "timestamp'2024-01-01' timestamp")
    assert [r._decoded for r in decode.decode_messages(rows).collect()] == [False, False, False]


def test_records_survive_the_round_trip(spark):
    events = decode.decode_messages(messages(spark, 0, 5)).select(*schemas.USAGE_EVENT.fieldNames())
    records = decode.keyed_messages(events)
    assert {r.key.decode() for r in records.select(F.col("key").cast("string").cast("binary").alias("key")).collect()} == {"acc_0", "acc_1", "acc_2"}
    assertDataFrameEqual(records.select(decode.decode_json(F.col("value")).alias("e")).select("e.*"), events)


def test_redelivered_events_drop_out_of_the_stream(spark, tmp_path):
    land(spark, tmp_path, 0, 6)
    land(spark, tmp_path, 2, 6)
    stream = decode.decode_messages(decode.read_landed_messages(spark, str(tmp_path / "in"))).where("_decoded")
    query = (
        lake.drop_redelivered(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    ids = [r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(ids) == sorted({f"evt_{n}" for n in range(8)})


def test_late_events_of_later_batches_stay(spark, tmp_path):
    # Seven days of events in reverse order, a file a trigger: none may fall behind a watermark.
    body = F.to_json(F.struct(*[F.col(c) for c in schemas.USAGE_EVENT.fieldNames()]))
    for day in (7, 3, 6, 1, 5, 2, 3):
        stamped = decode.decode_messages(messages(spark, day * 10, 4)).select(*schemas.USAGE_EVENT.fieldNames())
        stamped = stamped.withColumn("event_timestamp", F.lit(1_704_067_200_000 + day * 86_400_000).cast("long"))
        stamped.select(
            F.lit(None).cast("binary").alias("key"), body.cast("binary").alias("value"), F.lit("t").alias("topic"),
            F.lit(0).alias("partition"), F.lit(day).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"),
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    decoded = decode.decode_messages(decode.read_landed_messages(spark, str(tmp_path / "in"), max_files=1)).where("_decoded")
    query = (
        lake.drop_redelivered(decoded).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert len(query.recentProgress) >= 6
    out = [r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(out) == len(set(out)) == 24


def test_avro_schema_marks_required_fields():
    fields = {f["name"]: f["type"] for f in json.loads(decode.avro_schema())["fields"]}
    assert fields["event_timestamp"] == "long" and fields["account_id"] == "string"
    assert fields["metadata"] == ["null", "string"]
    assert list(fields) == schemas.USAGE_EVENT.fieldNames()


def test_lag_from_query_progress(spark):
    progress = {"sources": [{
        "endOffset": '{"usage": {"0": 100, "1": 50}}', "latestOffset": {"usage": {"0": 700, "1": 650, "2": 5}},
    }]}
    row, = quality.lag_status(decode.progress_offsets(spark, progress)).collect()
    assert (row.topic, row.total_lag, row.status) == ("usage", 1205, "warning")


def test_bounded_dedup_forgets_ids_and_keeps_late_events(spark, tmp_path):
    from usageledger.streaming import lake

    path, day = str(tmp_path), 86_400_000
    shape = "event_id string, event_timestamp long, _kafka_timestamp long"
    # Arrival day by day; each batch brings a copy of the day before and an event from 40 days ago.
    for n in range(6):
        batch = [(f"e{n}_{k}", n * day, n * day + k) for k in range(50)] + [(f"late{n}", (n - 40) * day, n * day + 60)]
        batch += [(f"e{n - 1}_{k}", (n - 1) * day, n * day + 70 + k) for k in range(50)] if n else []
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    running = lake.drop_redelivered_within(stream, "36 hours").writeStream.format("parquet").option(
        "checkpointLocation", f"{path}/c").trigger(availableNow=True).start(f"{path}/out")
    running.awaitTermination()
    got = [r.event_id for r in spark.read.parquet(f"{path}/out").collect()]
    assert sorted(got) == sorted([f"e{n}_{k}" for n in range(6) for k in range(50)] + [f"late{n}" for n in range(6)])
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress if p["stateOperators"]]
    # Ids of the first days have left the state: without a bound it would hold all 306.
    assert kept[-1] < 200
