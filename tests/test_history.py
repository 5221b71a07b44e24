import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from usageledger.operators.history import (
    apply_snapshot,
    current_versions,
    history_from_log,
    open_history,
)
from usageledger.operators.lookup import hot_keys

SHAPE = "account_id string, tier string, updated_at timestamp"
DAY = datetime(2024, 1, 1)


def day(n):
    return DAY + timedelta(days=n)


def extract(spark, *rows):
    return spark.createDataFrame([(k, t, day(d)) for k, t, d in rows], SHAPE)


def spans(history):
    columns = ["account_id", "tier", "dbt_valid_from", "dbt_valid_to"]
    return sorted((tuple(r) for r in history.select(*columns).collect()), key=str)


def test_every_kind_of_change(spark):
    start = open_history(
        extract(spark, ("same", "a", 0), ("newer", "a", 0), ("older", "a", 5), ("gone", "a", 0)), "account_id"
    )
    after = apply_snapshot(
        start,
        extract(spark, ("same", "changed but not newer", 0), ("newer", "b", 3), ("older", "z", 1), ("fresh", "n", 2)),
        "account_id",
        day(9),
    )
    assert spans(after) == sorted([
        ("same", "a", day(0), None),
        ("newer", "a", day(0), day(3)),
        ("newer", "b", day(3), None),
        ("older", "a", day(5), None),
        ("gone", "a", day(0), day(9)),
        ("fresh", "n", day(2), None),
    ], key=str)
    # a deleted key that returns opens a version, and its closed one stays as it was
    back = apply_snapshot(
        after, extract(spark, ("same", "a", 0), ("newer", "b", 3), ("older", "a", 5), ("fresh", "n", 2), ("gone", "c", 12)),
        "account_id", day(13),
    )
    assert ("gone", "a", day(0), day(9)) in spans(back)
    assert ("gone", "c", day(12), None) in spans(back)
    assert back.count() == after.count() + 1


def test_missing_keys_may_stay_open(spark):
    start = open_history(extract(spark, ("a", "x", 0)), "account_id")
    kept = apply_snapshot(start, extract(spark, ("b", "y", 0)), "account_id", day(1), close_missing=False)
    assert current_versions(kept).count() == 2


def test_same_extract_again_changes_nothing(spark):
    source = extract(spark, ("a", "x", 0), ("b", "y", 1))
    start = open_history(source, "account_id")
    assertDataFrameEqual(apply_snapshot(start, source, "account_id", day(5)), start)


def test_columns_may_come_and_go(spark):
    start = open_history(extract(spark, ("a", "x", 0), ("b", "x", 0)), "account_id")
    grown = extract(spark, ("a", "x", 2), ("b", "x", 0)).withColumn("region", F.lit("EU")).drop("tier")
    rows = {(r.account_id, r.dbt_valid_to is None): r for r in apply_snapshot(start, grown, "account_id", day(3)).collect()}
    assert rows["a", True].region == "EU" and rows["a", True].tier is None
    assert rows["a", False].region is None and rows["a", False].tier == "x"
    assert rows["b", True].region is None


def test_log_equals_repeated_snapshots(spark):
    rng = random.Random(7)
    keys = [f"k{i}" for i in range(8)]
    state, log, history = {}, [], None
    for step in range(6):
        for key in keys:
            if key not in state or rng.random() < 0.5:
                moment = DAY + timedelta(hours=step * 30 + rng.randrange(29), seconds=rng.randrange(3600))
                state[key] = (key, f"t{step}", moment)
                log.append(state[key])
        source = spark.createDataFrame(list(state.values()), SHAPE)
        if history is None:
            history = open_history(source, "account_id")
        else:
            history = apply_snapshot(history, source, "account_id", datetime(2030, 1, 1))
        history = spark.createDataFrame(history.collect(), history.schema)
    table = spark.createDataFrame(log + log[:5], SHAPE)
    some = spark.createDataFrame([("k1",), ("k4",)], "account_id string")
    for hot in (None, some, table.select("account_id").distinct()):
        bulk = history_from_log(table, "account_id", hot=hot)
        assertDataFrameEqual(bulk.select(*history.columns), history)


def test_log_of_one_hot_key_links_across_buckets(spark):
    log = spark.range(5000).select(
        F.lit("hot").alias("account_id"),
        F.col("id").cast("string").alias("tier"),
        (F.lit(DAY).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 7).cast("int"))).alias("updated_at"),
    )
    hot = hot_keys(log, "account_id", floor=1000)
    assert hot.count() == 1
    history = history_from_log(log, "account_id", hot=hot)
    assert current_versions(history).count() == 1
    gaps = history.where(F.col("dbt_valid_to") != F.col("dbt_valid_from") + F.expr("interval 7 minutes"))
    assert history.count() == 5000 and gaps.isEmpty()


def test_one_busy_hour_of_a_hot_key_is_cut(spark):
    log = spark.range(7200).select(
        F.lit("hot").alias("account_id"), F.lit("t").alias("tier"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 500_000).alias("updated_at"),
    )
    history = history_from_log(log, "account_id", hot=hot_keys(log, "account_id", floor=1000))
    assert history.count() == 7200 and current_versions(history).count() == 1
    assert history.where(F.unix_micros("dbt_valid_to") - F.unix_micros("dbt_valid_from") != 500_000).isEmpty()
