import random
from collections import defaultdict
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from usageledger.plans import usage
from usageledger.schemas import RAW_USAGE_EVENTS
from usageledger.sources.tables import day_range, parse_day

UTC_MS = {
    d: int(datetime(2024, 1, d, tzinfo=timezone.utc).timestamp() * 1000) for d in range(1, 32)
}


def event(n, day=1, load=None, account="acc_1", user="u1", kind="login", feature="dash", session="s1", at=None):
    return (
        f"evt_{n}" if n is not None else None, account, user, kind, feature, session,
        UTC_MS[day] if at is None else at, '{"browser":"chrome","os":"linux"}', None, None,
        datetime(2024, 1, load or day, 3),
    )


def events(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_USAGE_EVENTS)


def random_events(spark, count=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        day = rng.randrange(1, 25)
        rows.append(event(
            rng.randrange(250), day, min(31, day + rng.randrange(3)),
            rng.choice(["acc_1", "acc_1", "acc_2", None]), f"u{rng.randrange(5)}",
            rng.choice(["login", " LOGIN ", "export"]), rng.choice(["a", " A", None]),
            rng.choice(["s1", "s2", None]), UTC_MS[day] + rng.randrange(86_400_000),
        ))
    return events(spark, *rows).withColumn("_loaded_at", F.col("_loaded_at") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.pmod(F.xxhash64("event_id", "event_timestamp"), F.lit(9999)).cast("decimal(18,6)")
    ))


def brute_force(rows, label=lambda r: ()):
    """The daily metrics by hand: latest copy per label and id, then plain sets."""
    latest = {}
    for r in rows:
        if r.event_id is None:
            continue
        key = (*label(r), r.event_id)
        if key not in latest or r._loaded_at > latest[key]._loaded_at:
            latest[key] = r
    groups = defaultdict(list)
    for key, r in latest.items():
        if r.account_id is not None:
            day = datetime.fromtimestamp(r.event_timestamp / 1000, timezone.utc).date()
            feature = r.feature_name.strip().lower() if r.feature_name is not None else None
            groups[(*key[:-1], day, r.account_id, r.event_type.strip().lower(), feature)].append(r)
    return {
        key: (
            len(g), len({r.user_id for r in g} - {None}), len({r.session_id for r in g} - {None}),
            min(r.event_timestamp for r in g), max(r.event_timestamp for r in g),
        )
        for key, g in groups.items()
    }


MEASURES = ["event_count", "unique_users", "unique_sessions", "first_event_ts", "last_event_ts"]


def as_dict(frame, *labels):
    return {
        tuple(r[c] for c in [*labels, *usage.GRAIN]): tuple(r[c] for c in MEASURES)
        for r in frame.collect()
    }


def test_daily_equals_brute_force(spark):
    raw = random_events(spark)
    assert as_dict(usage.usage_daily(raw)) == brute_force(raw.collect())


def test_output_columns(spark):
    daily = usage.usage_daily(events(spark, event(1)))
    assert daily.columns == [*usage.GRAIN, *MEASURES, "_processed_at", "_source"]
    assert daily.first()["_source"] == "spark_batch"
    backfill = usage.usage_backfill(events(spark, event(1)), "2024-01-01", "2024-01-02")
    assert backfill.columns == [*daily.columns, "_batch_start", "_batch_end"]
    assert backfill.first()["_source"] == "spark_historical_backfill"


def test_dedup_comes_before_the_account_filter(spark):
    # the last copy lost its account: the event is dropped, not taken from the older copy
    raw = events(spark, event(1, load=1), event(1, load=2, account=None), event(None))
    assert usage.usage_daily(raw).isEmpty()


def test_midnight_and_late_events(spark):
    raw = events(spark, event(1, day=2, load=9), event(2, day=2, load=2, at=UTC_MS[2] - 1))
    days = {r.event_date for r in usage.usage_daily(raw).collect()}
    assert days == {date(2024, 1, 2), date(2024, 1, 1)}
    late = usage.usage_daily(raw, "2024-01-09").collect()
    assert [(r.event_date, r.event_count) for r in late] == [(date(2024, 1, 2), 1)]


def test_broker_position_settles_equal_load_times(spark):
    raw = events(spark, event(1, kind="first"), event(1, kind="second")).withColumns({
        "_kafka_partition": F.lit(0),
        "_kafka_offset": F.when(F.trim("event_type") == "first", 8).otherwise(5),
    })
    assert [r.event_type for r in usage.latest_events(raw).collect()] == ["first"]


@pytest.mark.parametrize("days", [1, 4, 7, 30, 50])
def test_backfill_batches_equal_a_loop_over_them(spark, days):
    first, last = date(2024, 1, 2), date(2024, 1, 23)
    raw = random_events(spark)
    bounds, opens = {}, first
    while opens <= last:
        closes = min(opens + timedelta(days=days - 1), last)
        for n in range((closes - opens).days + 1):
            bounds[opens + timedelta(days=n)] = (str(opens), str(closes))
        opens = closes + timedelta(days=1)
    inside = [r for r in raw.collect() if r._loaded_at.date() in bounds]
    expected = brute_force(inside, lambda r: bounds[r._loaded_at.date()])
    got = usage.usage_backfill(raw, first, last, days)
    assert as_dict(got, "_batch_start", "_batch_end") == expected


def test_one_batch_over_everything_is_the_daily_result(spark):
    raw = random_events(spark)
    whole = usage.usage_backfill(raw, "2024-01-01", "2024-01-31", 31)
    assert as_dict(whole) == as_dict(usage.usage_daily(raw))


def test_bad_ranges(spark):
    for bad in ("2024-1-xx", "01/02/2024", "2024-02-30"):
        with pytest.raises(ValueError):
            parse_day(bad)
    with pytest.raises(ValueError):
        day_range("2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        usage.usage_backfill(events(spark, event(1)), "2024-01-01", "2024-01-02", 0)


def test_recomputed_days_are_whole_and_notice_moved_events(spark):
    raw = random_events(spark)
    day = date(2024, 1, 12)
    rows = raw.collect()
    arrived = {r.event_id for r in rows if r._loaded_at.date() == day}
    affected = {
        datetime.fromtimestamp(r.event_timestamp / 1000, timezone.utc).date() for r in rows if r.event_id in arrived
    }
    expected = {k: v for k, v in brute_force(rows).items() if k[0] in affected}
    assert as_dict(usage.recompute_days(raw, day)) == expected


def test_a_tie_between_days_counts_on_one_of_them(spark):
    raw = events(spark, event(1, day=2, load=9, account="acc_9"), event(1, day=5, load=9, account="acc_1"), event(2, day=2, load=9))
    whole = as_dict(usage.usage_daily(raw))
    assert as_dict(usage.recompute_days(raw, "2024-01-09")) == whole
    assert as_dict(usage.recent_days(raw, "2024-01-06", 3)) == {k: v for k, v in whole.items() if k[0] >= date(2024, 1, 3)}
    assert as_dict(usage.recent_days(raw, "2024-01-03", 1)) == whole


def test_building_the_recomputation_runs_no_job(spark):
    raw = random_events(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job expected")
    try:
        usage.recompute_days(raw, "2024-01-12")
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_day_that_its_events_have_left_is_dropped(spark, tmp_path):
    raw_path, target = str(tmp_path / "raw"), str(tmp_path / "daily")
    events(spark, event(1, day=2, load=2)).write.parquet(raw_path)
    usage.run_usage_daily(spark, raw_path, target, "2024-01-02")
    events(spark, event(1, day=1, load=3)).write.mode("append").parquet(raw_path)
    usage.run_usage_daily(spark, raw_path, target, "2024-01-03")
    table = [(r.event_date, r.event_count) for r in spark.read.parquet(target).collect()]
    assert table == [(date(2024, 1, 1), 1)]


def test_recent_days_drop_what_is_empty_now(spark, tmp_path):
    raw_path, target = str(tmp_path / "raw"), str(tmp_path / "daily")
    events(spark, event(1, day=2, load=2), event(2, day=1, load=2)).write.parquet(raw_path)
    usage.run_recent_days(spark, raw_path, target, "2024-01-03")
    events(spark, event(1, day=1, load=3)).write.mode("append").parquet(raw_path)
    usage.run_recent_days(spark, raw_path, target, "2024-01-03")
    assert {r.event_date for r in spark.read.parquet(target).collect()} == {date(2024, 1, 1)}


def test_final_timestamps_give_the_same_result_when_they_are_final(spark):
    raw = random_events(spark).withColumn(
        "event_timestamp", F.lit(UTC_MS[1]) + F.pmod(F.xxhash64("event_id"), F.lit(20)) * 86_400_000
    )
    assert as_dict(usage.recompute_days(raw, "2024-01-12", timestamps_final=True)) == as_dict(
        usage.recompute_days(raw, "2024-01-12")
    )


def test_daily_job_keeps_other_days_and_repeats_cleanly(spark, tmp_path):
    raw_path, target = str(tmp_path / "raw"), str(tmp_path / "daily")
    raw = events(spark, event(1, day=1), event(2, day=2), event(3, day=1, load=2, user="u2"))
    raw.withColumn("load_date", F.to_date("_loaded_at")).write.partitionBy("load_date").parquet(raw_path)
    assert usage.run_usage_daily(spark, raw_path, target, "2024-01-01") == 1
    for _ in range(2):
        usage.run_usage_daily(spark, raw_path, target, "2024-01-02")
        table = {r.event_date: (r.event_count, r.unique_users) for r in spark.read.parquet(target).collect()}
        # the late event of load day 2 is added to what day 1 already had
        assert table == {date(2024, 1, 1): (2, 2), date(2024, 1, 2): (1, 1)}


def test_backfill_job(spark, tmp_path):
    raw_path, target = str(tmp_path / "raw"), str(tmp_path / "daily")
    random_events(spark).write.parquet(raw_path)
    shown = usage.run_usage_backfill(spark, raw_path, target, "2024-01-01", "2024-01-31", 7, dry_run=True, recompute=False)
    assert not (tmp_path / "daily").exists() and len(shown["preview"]) == 5
    for _ in range(2):
        done = usage.run_usage_backfill(spark, raw_path, target, "2024-01-01", "2024-01-31", 7, recompute=False)
        assert done["rows"] == shown["rows"] == spark.read.parquet(target).count()
    usage.run_usage_backfill(spark, raw_path, target, "2024-01-01", "2024-01-31", 7, append=True)
    assert spark.read.parquet(target).count() == 2 * done["rows"]


def test_backfill_and_daily_job_share_a_table(spark, tmp_path):
    raw_path, target = str(tmp_path / "raw"), str(tmp_path / "daily")
    events(spark, *[event(n, day=1, load=1 + n % 3) for n in range(10)]).write.parquet(raw_path)
    usage.run_usage_daily(spark, raw_path, target, "2024-01-01")
    assert usage.run_usage_backfill(spark, raw_path, target, "2024-01-02", "2024-01-02")["rows"] == 1
    row = spark.read.parquet(target).first()
    assert (row.event_count, row._source) == (10, "spark_historical_backfill")
    with pytest.raises(ValueError, match="own"):
        usage.run_usage_backfill(spark, raw_path, target, "2024-01-02", "2024-01-02", recompute=False)


def test_refresh_of_recent_days(spark, tmp_path):
    raw_path, target = str(tmp_path / "raw"), str(tmp_path / "daily")
    raw = random_events(spark)
    raw.write.parquet(raw_path)
    usage.run_recent_days(spark, raw_path, target, "2024-01-20", days=3)
    expected = {k: v for k, v in brute_force(raw.collect()).items() if k[0] >= date(2024, 1, 17)}
    assert as_dict(spark.read.parquet(target)) == expected
    # these events are never loaded before they happen, so older loads do not matter
    usage.run_recent_days(spark, raw_path, target, "2024-01-20", days=3, loaded_since="2024-01-17")
    assert as_dict(spark.read.parquet(target)) == expected


def test_metadata_fields(spark):
    raw = events(spark, event(1)).withColumn("metadata", F.lit('{"browser":"edge","rows":7}'))
    row = usage.read_metadata(raw).first()
    assert (row.browser, row.os, row.rows) == ("edge", None, 7)
    broken = usage.read_metadata(raw.withColumn("metadata", F.lit("{oops"))).first()
    assert (broken.browser, broken.rows) == (None, None)


def test_hot_account_and_hot_copies(spark):
    # a third of the rows are copies of one event, another third one account
    raw = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "evt_hot").otherwise(F.concat(F.lit("e"), F.col("id").cast("string"))).alias("event_id"),
        F.when(F.col("id") % 3 == 1, "acc_hot").otherwise("acc_other").alias("account_id"),
        F.concat(F.lit("u"), (F.col("id") % 40).cast("string")).alias("user_id"),
        F.lit("login").alias("event_type"), F.lit("f").alias("feature_name"),
        F.concat(F.lit("s"), (F.col("id") % 90).cast("string")).alias("session_id"),
        (F.lit(UTC_MS[1]) + F.col("id")).alias("event_timestamp"),
        F.timestamp_micros(F.lit(UTC_MS[2] * 1000) + F.col("id")).alias("_loaded_at"),
    )
    got = {r.account_id: (r.event_count, r.last_event_ts) for r in usage.usage_daily(raw).collect()}
    assert got["acc_hot"] == (2000, UTC_MS[1] + 5998)
    assert got["acc_other"] == (2001, UTC_MS[1] + 5999)
    assertDataFrameEqual(usage.latest_events(raw).where("event_id = 'evt_hot'").select("event_timestamp"),
                         spark.createDataFrame([(UTC_MS[1] + 5997,)], "event_timestamp bigint"))
