"""What larger tables ask of the registered queries and of the steps they share."""

from datetime import datetime, timezone

from compare import connect, spark_rows, sql_rows
from usageledger.streaming import decode
from usageledger.workload import oracles, queries
from usageledger.workload.queries import REGISTRY

TABLES = "/root/testdata/sf0.001"


def test_seed_sums_past_64_bits(spark, tmp_path):
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{TABLES}/{name}.parquet")
    events = spark.range(40_000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '9999-06-01 00:00:00' AS ts", "id % 9 AS user_id", "'login' AS event_type",
        "1.5D AS value", "'{}' AS props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    found = {r["table_name"]: r for r in REGISTRY["seed_load"](spark, str(tmp_path)).collect()}
    millis = int(datetime(9999, 6, 1, tzinfo=timezone.utc).timestamp()) * 1000
    assert found["usage_events"]["row_count"] == 42_000
    assert found["usage_events"]["checksum"] == 42_000 * millis > 2**63
    small = REGISTRY["seed_load"](spark, TABLES)
    assert small.schema["checksum"].dataType.simpleString() == "bigint"


def _triggers(spark, monkeypatch, name):
    """A stream's rows beside its SQL over 10,500 messages, with files of 250, and the files it took a trigger."""
    taken, read = [], decode.read_landed_messages

    def seen(spark, path, max_files):
        taken.append((max_files, len(spark.read.parquet(path).inputFiles())))
        return read(spark, path, max_files)

    monkeypatch.setattr(queries, "FILE_MESSAGES", 250, raising=False)
    monkeypatch.setattr(decode, "read_landed_messages", seen)
    tables = "/root/testdata/sf0.01"
    assert spark_rows(REGISTRY[name](spark, tables)) == sql_rows(connect(tables), oracles.SQL[name])
    return taken


def test_bounded_stream_reads_a_trigger_in_parallel(spark, monkeypatch):
    (files, landed), = _triggers(spark, monkeypatch, "stream_dedup_bounded")
    assert files > 4 and landed == 6 * files


def test_stream_reads_a_trigger_in_parallel(spark, monkeypatch):
    (files, landed), = _triggers(spark, monkeypatch, "stream_dedup")
    assert files > 4 and landed == 6 * files
