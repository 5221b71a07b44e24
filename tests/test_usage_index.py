"""Metrics brought forward load by load against metrics of all events at once."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from compare import plan_text
from usageledger.plans import usage, usage_index
from usageledger.sinks import versions
from usageledger.sinks.files import write_partitioned
from usageledger.sources.tables import read_events
from usageledger.workload import domain

SHAPE = (
    "event_id string, account_id string, user_id string, event_type string, feature_name string, session_id string,"
    " event_timestamp long, metadata string, _kafka_offset int, _kafka_partition int, load_date date"
)
FIRST = date(2024, 3, 1)
HOUR = 3_600_000


def event(n, hour, load, user="u1", account="a1", kind="api_call", feature=None, offset=None):
    stamp = None if hour is None else 1_704_067_200_000 + hour * HOUR
    return (f"e{n}", account, user, kind, feature, f"s{user}", stamp, None, offset or n, 0, FIRST + timedelta(days=load))


def land(spark, path, *events):
    made = spark.createDataFrame(list(events), SHAPE).withColumn("_loaded_at", F.col("load_date").cast("timestamp"))
    write_partitioned(made, path, "load_date", append=True)


def same(spark, raw, state):
    wanted = usage.usage_daily(spark.read.parquet(raw)).drop("_processed_at")
    got = usage_index.usage_metrics(spark, state).select(*wanted.columns)
    assert got.exceptAll(wanted).collect() == [] and wanted.exceptAll(got).collect() == []


def test_days_that_only_gain_events_are_brought_forward(spark, tmp_path):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    land(spark, raw, event(1, 1, 0), event(2, 2, 0, "u2"), event(3, 30, 0), event(4, None, 0))
    land(spark, raw, event(5, 3, 1), event(6, 4, 1, "u3"), event(7, 31, 1, "u2", "a2"), event(8, None, 1, "u2"), event(9, 2, 1, None))
    assert usage_index.load_days(spark, raw, state, FIRST) == {"events": 4, "days_forward": 3, "days_again": 0}
    assert usage_index.load_days(spark, raw, state, FIRST + timedelta(days=1)) == {"events": 5, "days_forward": 3, "days_again": 0}
    same(spark, raw, state)
    # a load again, and one without events
    assert usage_index.load_days(spark, raw, state, FIRST)["events"] == 0
    assert usage_index.load_days(spark, raw, state, FIRST + timedelta(days=9)) == {"events": 0, "days_forward": 0, "days_again": 0}
    same(spark, raw, state)


def test_moved_replaced_and_late_events(spark, tmp_path):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    land(spark, raw, event(1, 1, 0), event(2, 2, 0, "u2"), event(3, 50, 0), event(4, None, 0), event(5, 80, 0))
    # moved to another day, lost its account, got a time, changed its user
    land(spark, raw, event(1, 60, 1), event(2, 2, 1, "u2", None), event(4, 5, 1), event(5, 80, 1, "u9"))
    # only one event moved away from its day; an older copy arrives late; equal load time, later position
    land(spark, raw, event(3, -900, 2, offset=7), event(3, -800, 2, offset=6), event(8, 1, 2))
    for n in (1, 0, 2):
        usage_index.load_days(spark, raw, state, FIRST + timedelta(days=n))
    same(spark, raw, state)
    assert usage_index.read_state(spark, state, "index").count() == 6


def test_a_load_that_stops_is_done_again(spark, tmp_path, monkeypatch):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    land(spark, raw, event(1, 1, 0), event(2, 2, 0, "u2"))
    land(spark, raw, event(1, 60, 1), event(3, 2, 1, "u3"))
    usage_index.load_days(spark, raw, state, FIRST)
    before = sorted(usage_index.usage_metrics(spark, state).collect())
    whole, calls = versions.publish, []

    def die(spark, path, *rest, **named):
        calls.append(path)
        if len(calls) == stop:
            raise RuntimeError("the driver is gone")
        return whole(spark, path, *rest, **named)

    for stop in (1, 3, 5):
        calls.clear()
        with monkeypatch.context() as broken:
            broken.setattr(versions, "publish", die)
            with pytest.raises(RuntimeError):
                usage_index.load_days(spark, raw, state, FIRST + timedelta(days=1))
        assert sorted(usage_index.usage_metrics(spark, state).collect()) == before
    usage_index.load_days(spark, raw, state, FIRST + timedelta(days=1))
    same(spark, raw, state)
    assert usage_index.clean_state(spark, state) > 0
    same(spark, raw, state)


def test_a_load_scans_its_own_days_alone(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_partitioned(domain.usage_loads(spark, "/root/testdata/sf0.001", FIRST), raw, "load_date", ["event_id"])
    plan = plan_text(usage_index.arriving(read_events(spark, raw), FIRST, FIRST))
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(load_date" in plan


def test_daily_job_counts_events_without_a_time(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "daily")
    land(spark, raw, event(1, None, 0))
    usage.run_usage_daily(spark, raw, target, FIRST, recompute=False)
    land(spark, raw, event(2, None, 1, "u2"))
    usage.run_usage_daily(spark, raw, target, FIRST + timedelta(days=1))
    found = spark.read.parquet(target).collect()
    assert [(r.event_date, r.event_count, r.unique_users) for r in found] == [(None, 2, 2)]
    usage.run_usage_backfill(spark, raw, target, FIRST, FIRST + timedelta(days=1))
    assert [(r.event_date, r.event_count) for r in spark.read.parquet(target).collect()] == [(None, 2)]
