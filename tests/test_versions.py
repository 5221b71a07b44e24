"""Tables that change by version: whole or absent, whatever step a run stops at."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from test_billing import accounts, raw_book, raw_subscription
from usageledger.operators.history import open_history
from usageledger.plans import billing
from usageledger.plans.billing_run import run_facts
from usageledger.schemas import RAW_SUBSCRIPTIONS
from usageledger.sinks import versions
from usageledger.sinks.files import write_partitioned

JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, v int, month date")


def content(frame):
    return sorted((r.k, r.v, str(r.month)) for r in frame.collect())


def published(spark, path, *values):
    made = rows(spark, *values)
    return versions.publish(spark, path, versions.add_files(made, path, "month", ["k"]), made.schema, 7)


def test_a_version_is_its_list(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read(spark, path) is None and versions.version(spark, path) == versions.Version()
    first = published(spark, path, ("a", 1, JAN), ("b", 2, None))
    assert (first.number, first.mark) == (1, 7)
    versions.add_files(rows(spark, ("stray", 9, FEB)), path, "month")
    assert content(versions.read(spark, path)) == [("a", 1, "2024-01-01"), ("b", 2, "None")]
    assert versions.version(spark, path) == first
    second = versions.publish(spark, path, [], first and versions.read(spark, path).schema, after=1)
    assert content(versions.read(spark, path)) == [] and content(versions.read(spark, path, first)) != []
    with pytest.raises(RuntimeError, match="another run"):
        versions.publish(spark, path, [], versions.read(spark, path).schema, after=1)
    assert versions.clean(spark, path, [1]) == 1 and versions.numbers(spark, path) == [1, 2]
    assert versions.clean(spark, path) == 2 and versions.numbers(spark, path) == [second.number]
    assert versions.data_files(spark, path) == [] and not list((tmp_path / "t").glob("month=*"))


def test_one_updated_key_rewrites_one_file_of_fifty(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = rows(spark).schema
    # The partition's files have names in common with those of other partitions.
    files = [f for n in range(10) for f in versions.add_files(
        rows(spark, *[(f"k{n}_{m}_{i}", i, date(2024, 1 + m, 1)) for m in range(5) for i in range(4)]), path, "month")]
    base = versions.publish(spark, path, files, schema)
    assert len(base.files) == 50
    staged = versions.stage_merge(spark, path, base, rows(spark, ("k3_2_1", 77, MAR)), "k")
    assert len(staged.replaced) == 1 and staged.replaced[0].startswith("month=2024-03-01/")
    after = versions.publish_merge(spark, path, staged, "month", ["k"])
    assert len(set(base.files) & set(after.files)) == 49
    got = {r.k: r.v for r in versions.read(spark, path).collect()}
    assert len(got) == 200 and got["k3_2_1"] == 77


def test_merge_moves_rows_adds_columns_and_takes_unknown_months(spark, tmp_path):
    path = str(tmp_path / "t")
    base = published(spark, path, ("a", 1, JAN), ("b", 2, FEB), ("c", 3, None))
    updates = rows(spark, ("b", 5, None), ("c", 6, JAN), ("d", 7, FEB)).withColumn("extra", F.lit("x"))
    staged = versions.stage_merge(spark, path, base, updates, "k")
    wanted = [("a", 1, "2024-01-01"), ("b", 5, "None"), ("c", 6, "2024-01-01"), ("d", 7, "2024-02-01")]
    assert content(versions.merged_view(spark, path, staged)) == wanted
    assert content(versions.read(spark, path)) != wanted
    versions.publish_merge(spark, path, staged, "month", mark="m")
    merged = versions.read(spark, path)
    assert content(merged) == wanted and versions.version(spark, path).mark == "m"
    assert {r.k: r.extra for r in merged.collect()} == {"a": None, "b": "x", "c": "x", "d": "x"}
    with pytest.raises(ValueError, match="several"):
        versions.stage_merge(spark, path, versions.version(spark, path), updates.union(updates), "k")


def test_a_plain_table_is_version_zero(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(rows(spark, ("a", 1, JAN), ("b", 2, FEB)), path, "month")
    base = versions.version(spark, path)
    staged = versions.stage_merge(spark, path, base, rows(spark, ("b", 3, FEB)), "k")
    versions.publish_merge(spark, path, staged, "month")
    versions.clean(spark, path)
    assert content(spark.read.parquet(path).select("k", "v", "month")) == [("a", 1, "2024-01-01"), ("b", 3, "2024-02-01")]


def book(spark, *more):
    return billing.stg_subscriptions(raw_book(spark).union(spark.createDataFrame(list(more), RAW_SUBSCRIPTIONS)) if more else raw_book(spark))


@pytest.mark.parametrize("stop", ["stage_merge", "add_files", "publish", "clean"])
def test_a_fact_run_may_stop_at_any_step(spark, tmp_path, monkeypatch, stop):
    from datetime import datetime

    path, history = str(tmp_path / "facts"), open_history(accounts(spark), "account_id")
    run_facts(spark, book(spark), history, path)
    # Two updates in two months; only the first has arrived when the run stops.
    grown = book(
        spark,
        raw_subscription(0, 1, "growth", "cancelled", datetime(2024, 11, 2), created=1704067200),
        raw_subscription(99, 2, "starter", "active", datetime(2024, 11, 3)),
    )
    before = sorted(versions.read(spark, path).select("subscription_id", "subscription_status").collect())
    whole = getattr(versions, stop)

    def die(*given, **named):
        if stop == "add_files":
            whole(given[0].limit(1), *given[1:], **named)
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(versions, stop, die)
        with pytest.raises(RuntimeError):
            run_facts(spark, grown, history, path)
    seen = sorted(versions.read(spark, path).select("subscription_id", "subscription_status").collect())
    assert (seen == before) == (stop != "clean")
    facts = run_facts(spark, grown, history, path)
    got = {r.subscription_id: r.subscription_status for r in facts.collect()}
    assert facts.count() == len(got) == 25 and got["sub_0"] == "cancelled" and got["sub_99"] == "active"
    assert spark.read.parquet(path).count() == 25


def test_files_of_a_day_hold_ranges_of_accounts(spark, tmp_path):
    """Eight files a day; an account lies in two of them at most, one that owns a third of the rows in more."""
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    account = F.when(F.col("id") % 3 == 0, F.lit("acc_0500")).otherwise(F.concat(F.lit("acc_"), F.lpad((F.col("id") * 37 % 1000).cast("string"), 4, "0")))
    events = spark.range(24_000).select("id", account.alias("account_id"), (F.col("id") % 5).alias("event_type"), F.lit(JAN).alias("event_date"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert write_partitioned(events.repartition(5), path, "event_date", ["account_id", "event_type"], ranged=True) == 24_000
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    files = [pq.read_table(str(f), columns=["account_id", "id"]) for f in (tmp_path / "t").rglob("*.parquet")]
    spans = sorted((min(t["account_id"].to_pylist()), max(t["account_id"].to_pylist())) for t in files)
    assert len(spans) == 8 and max(t.num_rows for t in files) < 2 * 24_000 / 8
    for n in range(1000):
        name = f"acc_{n:04}"
        holding = sum(low <= name <= high for low, high in spans)
        assert holding <= 2 or name == "acc_0500" and holding <= 5
