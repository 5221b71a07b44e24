"""One registered query per operator or pipeline, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usageledger import fixed_values as fv
from usageledger import schemas
from usageledger.functions.columns import (
    banded,
    blank_to_null,
    hour_path,
    last_segment,
    moment,
    strict_day,
    surrogate_key,
    tidy,
    whole_units_between,
)
from usageledger.operators import checks
from usageledger.operators.dedup import duplicated
from usageledger.operators.evolve import append_evolving, schema_drift
from usageledger.operators.history import apply_snapshot, current_versions, history_from_log, snapshot_moves
from usageledger.operators.lookup import hot_keys, lookup, orphan_keys
from usageledger.operators.merge import merge_upsert, newer_rows, publish_merge, stage_merge
from usageledger.operators.retention import expire_path, unexpired
from usageledger.plans import billing, ingest, quality, reports, usage, usage_index
from usageledger.plans.billing_run import FACT_MONTH, run_facts, run_snapshot
from usageledger.session import scratch_path
from usageledger.sinks import versions
from usageledger.sinks.files import as_view, drop_partitions, rebuild, write_partitioned
from usageledger.sources.landed import read_csv, read_run_results
from usageledger.sources.tables import loaded_between
from usageledger.streaming import decode, lake
from usageledger.workload import domain
from usageledger.workload.domain import emit, table

AS_OF = datetime(2001, 8, 15)
USAGE_DAY = date(2024, 1, 15)
USAGE_RANGE = (date(2024, 1, 1), date(2024, 1, 31))
LOADED_SPLIT = datetime(2000, 1, 1)
VOLATILE = ["_processed_at"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return emit(function(spark, sf_dir))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    REGISTRY[function.__name__] = run
    return function


# --- usage ------------------------------------------------------------------


@query
def usage_daily(spark, sf_dir):
    return usage.usage_daily(domain.usage_events(spark, sf_dir)).drop(*VOLATILE)


@query
def usage_daily_one_load_day(spark, sf_dir):
    return usage.usage_daily(domain.usage_events(spark, sf_dir), USAGE_DAY).drop(*VOLATILE)


@query
def usage_dedup_latest(spark, sf_dir):
    return usage.latest_events(domain.usage_events(spark, sf_dir))


@query
def usage_clean(spark, sf_dir):
    return usage.clean_events(usage.latest_events(domain.usage_events(spark, sf_dir)))


@query
def usage_backfill_1d(spark, sf_dir):
    return usage.usage_backfill(domain.usage_events(spark, sf_dir), *USAGE_RANGE).drop(*VOLATILE)


@query
def usage_backfill_7d(spark, sf_dir):
    events = domain.usage_events(spark, sf_dir)
    return usage.usage_backfill(events, *USAGE_RANGE, batch_days=7).drop(*VOLATILE)


@query
def usage_recompute_days(spark, sf_dir):
    return usage.recompute_days(domain.usage_events(spark, sf_dir), USAGE_DAY).drop(*VOLATILE)


@query
def usage_recent_days(spark, sf_dir):
    return usage.recent_days(domain.usage_events(spark, sf_dir), "2024-01-30").drop(*VOLATILE)


@query
def usage_daily_table(spark, sf_dir):
    """The metrics as the partitioned table a reader would see."""
    path = scratch_path(spark, "usage-daily")
    metrics = usage.usage_daily(domain.usage_events(spark, sf_dir))
    write_partitioned(metrics, path, "event_date", usage.CLUSTER)
    return spark.read.parquet(path).drop(*VOLATILE)


@query
def usage_backfill_table(spark, sf_dir):
    """The range job on a raw table with load-date folders, read back."""
    path = scratch_path(spark, "usage-backfill")
    events = domain.usage_events(spark, sf_dir).withColumn("load_date", F.to_date("_loaded_at"))
    write_partitioned(events, f"{path}/raw", "load_date", ["event_id"])
    usage.run_usage_backfill(spark, f"{path}/raw", f"{path}/daily", *map(str, USAGE_RANGE), batch_days=7, recompute=False)
    return spark.read.parquet(f"{path}/daily").drop(*VOLATILE, usage.BATCH_FOLDER)


def _daily_table(spark, sf_dir):
    """Raw events loaded by the usage day as a raw table, its daily job done, and the later loads."""
    path = scratch_path(spark, "usage-jobs")
    events = domain.usage_events(spark, sf_dir).withColumn("load_date", F.to_date("_loaded_at"))
    write_partitioned(events.where(F.col("load_date") <= F.lit(USAGE_DAY)), f"{path}/raw", "load_date", ["event_id"])
    usage.run_usage_daily(spark, f"{path}/raw", f"{path}/daily", USAGE_DAY)
    return path, events


@query
def usage_daily_two_loads(spark, sf_dir):
    """Two daily runs; the second load moves every event of the first 40 days back."""
    path, events = _daily_table(spark, sf_dir)
    moved = events.where(F.col("load_date") == F.lit(USAGE_DAY)).withColumns({
        "event_timestamp": F.col("event_timestamp") - 40 * 86_400_000,
        "_loaded_at": F.col("_loaded_at") + F.make_dt_interval(F.lit(1)),
        "load_date": F.date_add("load_date", 1),
    })
    write_partitioned(moved, f"{path}/raw", "load_date", ["event_id"], append=True)
    usage.run_usage_daily(spark, f"{path}/raw", f"{path}/daily", USAGE_DAY + timedelta(days=1))
    return spark.read.parquet(f"{path}/daily").drop(*VOLATILE)


@query
def usage_daily_then_backfill(spark, sf_dir):
    """A daily run, all later loads, then a backfill of some of them into the same table."""
    path, events = _daily_table(spark, sf_dir)
    write_partitioned(events.where(F.col("load_date") > F.lit(USAGE_DAY)), f"{path}/raw", "load_date", append=True)
    first, last = USAGE_DAY, USAGE_DAY + timedelta(days=3)
    usage.run_usage_backfill(spark, f"{path}/raw", f"{path}/daily", first, last)
    return spark.read.parquet(f"{path}/daily").drop(*VOLATILE)


@query
def usage_null_times(spark, sf_dir):
    """Two daily runs over loads in which a third of the events have no time: they share the NULL day."""
    path, later = scratch_path(spark, "usage-null-times"), USAGE_DAY + timedelta(days=1)
    events = domain.usage_events(spark, sf_dir).withColumns({
        "event_timestamp": F.when(domain.event_number() % 3 == 1, None).otherwise(F.col("event_timestamp")),
        "load_date": F.to_date("_loaded_at"),
    })
    write_partitioned(events.where(F.col("load_date") <= F.lit(USAGE_DAY)), f"{path}/raw", "load_date", ["event_id"])
    usage.run_usage_daily(spark, f"{path}/raw", f"{path}/daily", USAGE_DAY)
    write_partitioned(events.where(F.col("load_date") == F.lit(later)), f"{path}/raw", "load_date", ["event_id"])
    usage.run_usage_daily(spark, f"{path}/raw", f"{path}/daily", later)
    return spark.read.parquet(f"{path}/daily").drop(*VOLATILE)


@query
def usage_incremental_loads(spark, sf_dir):
    """Five loads through the event index: copies in later loads, events without a time, moved events."""
    path = scratch_path(spark, "usage-index")
    first = date(2024, 3, 1)
    write_partitioned(domain.usage_loads(spark, sf_dir, first), f"{path}/raw", "load_date", ["event_id"])
    for n in range(domain.LOADS):
        usage_index.load_days(spark, f"{path}/raw", f"{path}/state", first + timedelta(days=n))
    return usage_index.usage_metrics(spark, f"{path}/state")


@query
def usage_dry_run(spark, sf_dir):
    """What the range job would write, counted without writing."""
    path = scratch_path(spark, "usage-dry")
    write_partitioned(domain.usage_events(spark, sf_dir).withColumn("load_date", F.to_date("_loaded_at")), path, "load_date")
    shown = usage.run_usage_backfill(spark, path, f"{path}-none", *USAGE_RANGE, dry_run=True, recompute=False)
    return spark.createDataFrame([(shown["rows"], len(shown["preview"]))], "row_count bigint, shown int")


@query
def usage_appended_batches(spark, sf_dir):
    """The range job run twice with `append`: every batch is there twice."""
    path = scratch_path(spark, "usage-append")
    write_partitioned(domain.usage_events(spark, sf_dir).withColumn("load_date", F.to_date("_loaded_at")), path, "load_date")
    for _ in range(2):
        usage.run_usage_backfill(spark, path, f"{path}-daily", *USAGE_RANGE, batch_days=7, append=True)
    return spark.read.parquet(f"{path}-daily").drop(*VOLATILE, usage.BATCH_FOLDER)


@query
def usage_view(spark, sf_dir):
    """Plain SQL over a registered view of the raw events."""
    as_view(domain.usage_events(spark, sf_dir), "usage_events_raw")
    return spark.sql(
        "SELECT account_id, count(*) AS event_count, max(event_timestamp) AS last_event_ts"
        " FROM usage_events_raw GROUP BY account_id"
    )


@query
def usage_event_type_mix(spark, sf_dir):
    return usage.event_type_mix(domain.usage_events(spark, sf_dir))


@query
def usage_metadata_json(spark, sf_dir):
    parsed = usage.read_metadata(domain.usage_events(spark, sf_dir), "k int")
    return parsed.groupBy("k").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_distinct("event_id").alias("unique_events")
    )


@query
def load_range_scan(spark, sf_dir):
    events = loaded_between(domain.usage_events(spark, sf_dir), "2024-01-10", "2024-01-12")
    return events.select("event_id", "event_type", "_loaded_at")


@query
def event_lake_paths(spark, sf_dir):
    """The hour folder of every event."""
    path = hour_path("_loaded_at", "raw/events").alias("folder")
    return domain.usage_events(spark, sf_dir).groupBy(path).agg(F.count(F.lit(1)).alias("record_count"))


# --- billing ----------------------------------------------------------------


def _staged(spark, sf_dir):
    return billing.stg_subscriptions(domain.raw_subscriptions(spark, sf_dir))


def _staging_table(spark, sf_dir):
    """Staging as a table, as the billing run keeps it, for runs that read it one after another."""
    path = scratch_path(spark, "stg-subscriptions")
    rows = _staged(spark, sf_dir)
    rebuild(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def _facts(spark, sf_dir):
    return billing.fct_subscriptions(
        _staged(spark, sf_dir), domain.account_history(spark, sf_dir), domain.hot_accounts(spark, sf_dir)
    )


@query
def stg_subscriptions(spark, sf_dir):
    return _staged(spark, sf_dir)


@query
def fct_subscriptions(spark, sf_dir):
    return _facts(spark, sf_dir)


@query
def account_metrics(spark, sf_dir):
    return billing.account_metrics(_facts(spark, sf_dir))


@query
def plan_metrics(spark, sf_dir):
    metrics = billing.plan_metrics(_facts(spark, sf_dir))
    return metrics.withColumn("avg_active_mrr", F.round(F.col("avg_active_mrr").cast("double"), 4))


@query
def mrr_by_status(spark, sf_dir):
    return billing.mrr_by_status(_facts(spark, sf_dir))


@query
def rpt_subscription_monthly(spark, sf_dir):
    return reports.subscription_monthly(
        _facts(spark, sf_dir), domain.account_history(spark, sf_dir), domain.hot_accounts(spark, sf_dir)
    )


@query
def rpt_account_overview(spark, sf_dir):
    metrics = billing.account_metrics(_facts(spark, sf_dir))
    return reports.account_overview(domain.account_history(spark, sf_dir), metrics, AS_OF)


@query
def account_segments(spark, sf_dir):
    overview = rpt_account_overview(spark, sf_dir)
    return overview.groupBy("account_health_segment", "product_adoption", "engagement_status").agg(
        F.count(F.lit(1)).alias("account_count"), F.sum("total_mrr").alias("segment_mrr")
    )


@query
def surrogate_keys(spark, sf_dir):
    rows = domain.usage_events(spark, sf_dir)
    return rows.select(
        "event_id", "_loaded_at", surrogate_key("event_id", "account_id", "feature_name").alias("event_key")
    )


@query
def text_cleanup(spark, sf_dir):
    raw = domain.raw_subscriptions(spark, sf_dir)
    return raw.groupBy(
        tidy("status", any_whitespace=True).alias("status"),
        tidy("currency", upper=True).alias("currency"),
        blank_to_null(F.trim("billing_interval")).alias("billing_interval"),
        last_segment("plan_id", "-").alias("plan_name"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


# --- table state ------------------------------------------------------------


@query
def incremental_new_rows(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    loaded = staged.where(F.col("_loaded_at") <= moment(LOADED_SPLIT))
    return newer_rows(staged, loaded).select("subscription_id", "_loaded_at")


def _merge_sides(spark, sf_dir):
    """A table loaded before a date, and a later load of everything started since 1999.

    Updates move cancelled subscriptions a year back, so they change their month.
    """
    facts = _facts(spark, sf_dir).withColumn("started_month", F.trunc("started_at", "month"))
    target = facts.where(F.col("_loaded_at") <= moment(LOADED_SPLIT))
    moved = F.when(
        F.col("subscription_status") == "cancelled", F.col("started_at") - F.make_dt_interval(F.lit(365))
    ).otherwise(F.col("started_at"))
    updates = facts.where(F.col("started_at") >= F.lit(date(1999, 1, 1)).cast("timestamp")).withColumns({
        "mrr_amount": (F.col("mrr_amount") + 1).cast("decimal(18,6)"),
        "started_at": moved,
        "started_month": F.to_date(F.trunc(moved, "month")),
    })
    return target, updates


MERGE_OUTPUT = ["subscription_id", "subscription_status", "mrr_amount", "started_at", "started_month"]


@query
def merge_upsert_rows(spark, sf_dir):
    target, updates = _merge_sides(spark, sf_dir)
    return merge_upsert(target, updates, "subscription_id").select(*MERGE_OUTPUT)


@query
def merge_partitioned_table(spark, sf_dir):
    """The same merge as a job on a month-partitioned table."""
    path = scratch_path(spark, "fct-subscriptions")
    target, updates = _merge_sides(spark, sf_dir)
    cluster = ["account_id", "subscription_status"]
    rebuild(target, path, "started_month", cluster)
    staged = stage_merge(spark, path, updates, "subscription_id", "started_month")
    publish_merge(spark, staged, path, "started_month", cluster)
    return spark.read.parquet(path).select(*MERGE_OUTPUT)


@query
def merge_resumed(spark, sf_dir):
    """The same job, stopped after it dropped emptied partitions and before it wrote, and run again."""
    path = scratch_path(spark, "fct-resumed")
    target, updates = _merge_sides(spark, sf_dir)
    cluster = ["account_id", "subscription_status"]
    rebuild(target, path, "started_month", cluster)
    stopped = stage_merge(spark, path, updates, "subscription_id", "started_month")
    filled = {r[0] for r in spark.read.parquet(stopped.result).select("started_month").distinct().collect()}
    drop_partitions(spark, path, "started_month", set(stopped.touched) - filled)
    staged = stage_merge(spark, path, updates, "subscription_id", "started_month")
    publish_merge(spark, staged, path, "started_month", cluster)
    return spark.read.parquet(path).select(*MERGE_OUTPUT)


@query
def merge_file_level(spark, sf_dir):
    """The same merge by files: only those that hold an updated subscription are written anew."""
    path = scratch_path(spark, "fct-by-file")
    target, updates = _merge_sides(spark, sf_dir)
    cluster = ["account_id", "subscription_status"]
    files = versions.add_files(target, path, "started_month", cluster)
    base = versions.publish(spark, path, files, target.schema)
    staged = versions.stage_merge(spark, path, base, updates, "subscription_id")
    versions.publish_merge(spark, path, staged, "started_month", cluster)
    return versions.read(spark, path).select(*MERGE_OUTPUT)


def _facts_after_changes(spark, sf_dir, full_refresh):
    path = scratch_path(spark, "fct-two-runs")
    staged, history = _staging_table(spark, sf_dir), domain.account_history(spark, sf_dir)
    run_facts(spark, staged.where(F.col("_loaded_at") <= moment(LOADED_SPLIT)), history, path)
    later = apply_snapshot(history, domain.changed_accounts(spark, sf_dir), "account_id", AS_OF)
    facts = run_facts(spark, staged, later, path, full_refresh)
    return facts.select("subscription_id", "account_id", "account_sk", "subscription_status", "started_at")


@query
def facts_after_account_changes(spark, sf_dir):
    """Two fact runs with account changes in between: old facts move to the new versions."""
    return _facts_after_changes(spark, sf_dir, full_refresh=False)


@query
def facts_full_refresh(spark, sf_dir):
    """The second run as a full rebuild gives the same facts."""
    return _facts_after_changes(spark, sf_dir, full_refresh=True)


@query
def merge_stopped_midway(spark, sf_dir):
    """The second run again, after one that stopped when one month of its merge was in its place."""
    path = scratch_path(spark, "fct-stopped")
    staged, history = _staging_table(spark, sf_dir), domain.account_history(spark, sf_dir)
    run_facts(spark, staged.where(F.col("_loaded_at") <= moment(LOADED_SPLIT)), history, path)
    later = apply_snapshot(history, domain.changed_accounts(spark, sf_dir), "account_id", AS_OF)
    fresh = billing.fct_subscriptions(staged.where(F.col("_loaded_at") > moment(LOADED_SPLIT)), later)
    month = F.trunc("started_at", "month")
    versions.add_files(fresh.withColumn(FACT_MONTH, month).where(month == F.lit(date(2000, 2, 1))), path, FACT_MONTH)
    facts = run_facts(spark, staged, later, path)
    return facts.select("subscription_id", "account_id", "account_sk", "subscription_status", "started_at")


@query
def lookup_hot_key(spark, sf_dir):
    """Orders of which a third share one customer, joined through the split path."""
    hot_customer = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", hot_customer.cast("bigint").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name")
    return lookup(orders, customers, "c_custkey", ["o_orderkey"], hot_keys(orders, "c_custkey", floor=50))


@query
def schema_evolution_append(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    arriving = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("nation_key"),
    )
    return append_evolving(customers, arriving)


HISTORY_OUTPUT = ["account_id", "account_tier", "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


@query
def scd2_history(spark, sf_dir):
    return history_from_log(domain.account_log(spark, sf_dir), "account_id").select(*HISTORY_OUTPUT)


@query
def scd2_current(spark, sf_dir):
    history = history_from_log(domain.account_log(spark, sf_dir), "account_id")
    return current_versions(history).select(*HISTORY_OUTPUT)


@query
def scd2_apply_deletes(spark, sf_dir):
    """Accounts of one industry are new to the extract; overdrawn ones are gone from it."""
    history = domain.account_history(spark, sf_dir).where(F.col("industry") != "BUILDING")
    extract = domain.changed_accounts(spark, sf_dir).where(F.col("company_size_band") != "SMB")
    return apply_snapshot(history, extract, "account_id", AS_OF).select(*HISTORY_OUTPUT)


@query
def scd2_snapshot_runs(spark, sf_dir):
    """The same two extracts as consecutive runs of the stored history."""
    path = scratch_path(spark, "snap-accounts")
    first = domain.accounts(spark, sf_dir).where(F.col("industry") != "BUILDING")
    second = domain.changed_accounts(spark, sf_dir).where(F.col("company_size_band") != "SMB")
    run_snapshot(spark, first, path, datetime(2001, 1, 1))
    return run_snapshot(spark, second, path, AS_OF).select(*HISTORY_OUTPUT)


@query
def snapshot_resumed(spark, sf_dir):
    """A run between the two that stopped after it stored what it closed."""
    path = scratch_path(spark, "snap-resumed")
    first = domain.accounts(spark, sf_dir).where(F.col("industry") != "BUILDING")
    second = domain.changed_accounts(spark, sf_dir).where(F.col("company_size_band") != "SMB")
    held = run_snapshot(spark, first, path, datetime(2001, 1, 1))
    unfinished = snapshot_moves(current_versions(held), second, "account_id", datetime(2001, 8, 14))
    rebuild(unfinished.where(F.col("dbt_valid_to").isNotNull()), f"{path}/closed/run=20010814000000")
    return run_snapshot(spark, second, path, AS_OF).select(*HISTORY_OUTPUT)


@query
def expire_partitions(spark, sf_dir):
    events = domain.usage_events(spark, sf_dir).withColumn("load_date", F.to_date("_loaded_at"))
    kept = unexpired(events, date(2024, 1, 31), days=10)
    return kept.groupBy("load_date").agg(F.count(F.lit(1)).alias("row_count"))


@query
def expire_partitioned_table(spark, sf_dir):
    """The same expiry as a job on a partitioned table."""
    path = scratch_path(spark, "raw-events")
    events = domain.usage_events(spark, sf_dir).withColumn("load_date", F.to_date("_loaded_at"))
    write_partitioned(events, path, "load_date", ["event_id"])
    expire_path(spark, path, date(2024, 1, 31), days=10)
    left = spark.read.parquet(path)
    return left.groupBy("load_date").agg(F.count(F.lit(1)).alias("row_count"))


# --- quality ----------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    rows = domain.usage_events(spark, sf_dir)
    return checks.failing(rows, checks.not_null("account_id")).select("event_id", "_loaded_at")


@query
def dq_unique(spark, sf_dir):
    return checks.failing(domain.usage_events(spark, sf_dir), checks.unique("event_id"))


@query
def dq_accepted_values(spark, sf_dir):
    check = checks.accepted("subscription_status", [*fv.KNOWN_STATUSES, None])
    return checks.failing(_staged(spark, sf_dir), check).select("subscription_id", "subscription_status")


@query
def dq_range(spark, sf_dir):
    check = checks.within("total_cents", 10000, 400000)
    return checks.failing(domain.invoices(spark, sf_dir), check).select("invoice_id", "total_cents")


@query
def dq_length(spark, sf_dir):
    check = checks.length_is("currency", fv.CURRENCY_LENGTH)
    return checks.failing(_staged(spark, sf_dir), check).select("subscription_id", "currency")


@query
def dq_unique_combo(spark, sf_dir):
    check = checks.unique_together("invoice_id", "line_number")
    return checks.failing(domain.invoice_line_items(spark, sf_dir), check)


@query
def dq_relationships(spark, sf_dir):
    return orphan_keys(
        domain.invoice_line_items(spark, sf_dir), "invoice_id", domain.invoices(spark, sf_dir), "invoice_id"
    )


@query
def dq_account_relationships(spark, sf_dir):
    return orphan_keys(
        _staged(spark, sf_dir), "account_id", domain.accounts(spark, sf_dir), "account_id"
    )


@query
def dq_negative_mrr(spark, sf_dir):
    """Balances stand in for revenue, which is never negative in these tables."""
    rows = domain.accounts(spark, sf_dir).join(
        table(spark, sf_dir, "customer").select(
            F.concat(F.lit("acc_"), F.col("c_custkey").cast("string")).alias("account_id"),
            F.col("c_acctbal").alias("mrr_amount"),
        ),
        "account_id",
    ).withColumn("subscription_status", F.when(F.col("is_active"), "active").otherwise("cancelled"))
    return checks.failing(rows, quality.negative_mrr_check()).select("account_id", "mrr_amount")


@query
def dq_volume_anomaly(spark, sf_dir):
    return quality.volume_anomaly(domain.usage_events(spark, sf_dir), USAGE_DAY)


@query
def dq_mrr_reconciliation(spark, sf_dir):
    return quality.mrr_reconciliation(_staged(spark, sf_dir), _facts(spark, sf_dir))


@query
def dq_freshness(spark, sf_dir):
    return quality.freshness(domain.raw_subscriptions(spark, sf_dir), "_loaded_at", AS_OF)


@query
def dq_layer_age(spark, sf_dir):
    events = domain.usage_events(spark, sf_dir)
    return quality.layer_age(events, "_loaded_at", fv.LAKE_AGE_MINUTES, datetime(2024, 1, 31, 0, 30))


@query
def dq_duplicates(spark, sf_dir):
    return duplicated(domain.raw_subscriptions(spark, sf_dir), ["id"])


@query
def dq_declared_tests(spark, sf_dir):
    """Every declared test of every model; each model is built once, written, and tested."""
    path = scratch_path(spark, "declared-tests")

    def built(rows: DataFrame, name: str) -> DataFrame:
        rebuild(rows, f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    history, hot = domain.account_history(spark, sf_dir), domain.hot_accounts(spark, sf_dir)
    staged = built(_staged(spark, sf_dir), "stg")
    facts = built(billing.fct_subscriptions(staged, history, hot), "fct")
    per_account = built(billing.account_metrics(facts), "accounts")
    return quality.check_models({
        "raw_accounts": domain.accounts(spark, sf_dir),
        "raw_subscriptions": domain.raw_subscriptions(spark, sf_dir),
        "stg_subscriptions": staged,
        "snap_accounts": history,
        "int_account_metrics": per_account,
        "int_plan_metrics": built(billing.plan_metrics(facts), "plans"),
        "fct_subscriptions": facts,
        "rpt_subscription_monthly": built(reports.subscription_monthly(facts, history, hot), "monthly"),
        "rpt_account_overview": built(reports.account_overview(history, per_account, AS_OF), "overview"),
    })


@query
def dq_suite(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return quality.quality_suite(
        domain.raw_subscriptions(spark, sf_dir),
        staged,
        _facts(spark, sf_dir),
        {"staging": (staged, "_loaded_at")},
        date(2001, 7, 20),
        AS_OF,
    )


# --- reports over any table -------------------------------------------------


@query
def row_counts_union(spark, sf_dir):
    names = [
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
    ]
    return ingest.row_counts({name: table(spark, sf_dir, name) for name in names})


@query
def top10_expensive(spark, sf_dir):
    jobs = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("job_"), F.col("o_orderkey").cast("string")).alias("job_id"),
        F.col("o_orderpriority").alias("query"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_email"),
        F.floor(F.col("o_totalprice") * 1000000).alias("total_bytes_processed"),
        F.floor(F.col("o_totalprice")).alias("total_slot_ms"),
        F.col("o_orderdate").cast("timestamp").alias("creation_time"),
        F.when(F.col("o_orderpriority") == "5-LOW", "LOAD").otherwise("QUERY").alias("job_type"),
        F.when(F.col("o_orderstatus") == "P", "RUNNING").otherwise("DONE").alias("state"),
    )
    return ingest.expensive_jobs(jobs, moment(AS_OF) - F.make_dt_interval(F.lit(365)))


@query
def lag_status(spark, sf_dir):
    """Each event type is a topic; what came after the consumer's hour is its lag."""
    events = table(spark, sf_dir, "events")
    offsets = events.groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 6).alias("partition")
    ).agg(
        F.count(F.lit(1)).alias("log_end_offset"),
        F.count_if(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).alias("current_offset"),
    )
    return quality.lag_status(offsets)


@query
def age_bands(spark, sf_dir):
    age = whole_units_between("DAY", F.col("o_orderdate").cast("timestamp"), moment(AS_OF))
    band = banded(age, [(1500, "old"), (365, "settled")], "recent")
    return table(spark, sf_dir, "orders").groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("order_count"), F.max(age).alias("oldest_days")
    )


# --- ingestion --------------------------------------------------------------


def _payload(spark, sf_dir):
    """Subscriptions as the API delivers them, with the customer expanded."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("sub_"), F.col("o_orderkey").cast("string")).alias("id"),
            F.struct(
                F.concat(F.lit("acc_"), F.col("c_custkey").cast("string")).alias("id"),
                F.struct(F.col("c_mktsegment").alias("segment")).alias("address"),
            ).alias("customer"),
            F.struct(F.col("o_orderpriority").alias("id")).alias("plan"),
            F.col("o_orderstatus").alias("status"),
            F.floor(F.col("o_totalprice")).alias("amount"),
            F.array(
                F.struct(F.col("o_orderstatus").alias("code"), F.lit(1).alias("quantity"))
            ).alias("items"),
        )
    )


@query
def flatten_payload(spark, sf_dir):
    return ingest.flatten_payload(
        _payload(spark, sf_dir), "2024-11-01", datetime(2024, 11, 1, 2, 15)
    )


@query
def ingest_landed_json(spark, sf_dir):
    """The same payload landed as JSON lines, ingested, and read back."""
    path = scratch_path(spark, "payload")
    _payload(spark, sf_dir).write.json(f"{path}/landed")
    ingest.ingest_subscriptions(spark, f"{path}/landed", f"{path}/raw", "2024-11-01")
    return spark.read.parquet(f"{path}/raw").drop("_loaded_at")


@query
def ingest_type_drift(spark, sf_dir):
    """Three extracts in which the amount is unknown, a number, and text."""
    path = scratch_path(spark, "drift")
    payload = _payload(spark, sf_dir).drop("items")
    number = F.regexp_extract("id", "[0-9]+", 0).cast("bigint") % 3
    amounts = (F.lit(None).cast("string"), F.col("amount"), F.concat(F.lit("about "), F.col("amount").cast("string")))
    for n, amount in enumerate(amounts):
        extract = payload.where(number == n).withColumn("amount", amount)
        extract.write.option("ignoreNullFields", False).json(f"{path}/landed-{n}")
        ingest.ingest_subscriptions(spark, f"{path}/landed-{n}", f"{path}/raw", "2024-11-01")
    return spark.read.option("mergeSchema", True).parquet(f"{path}/raw").select("id", "amount")


@query
def gate_stops(spark, sf_dir):
    """Which checks the gate names when it stops a stage."""
    raw = domain.usage_events(spark, sf_dir)
    rules = {name: F.count_if(F.col(name).isNull()) for name in ("event_id", "account_id", "event_type")}
    counted = raw.agg(*[rule.alias(name) for name, rule in rules.items()])
    results = counted.unpivot([], list(rules), "check_name", "failures").select(
        "check_name", F.when(F.col("failures") > 0, "fail").otherwise("pass").alias("status")
    )
    try:
        checks.require_passing(results)
        stopped = ""
    except checks.ChecksFailed as reason:
        stopped = str(reason)
    return results.withColumn("named", F.lit(stopped).contains(F.concat(F.lit("check_name="), "check_name")))


@query
def schema_drift_columns(spark, sf_dir):
    """Drift of a landed customer table against its declaration, beside its row count."""
    customers = table(spark, sf_dir, "customer")
    declared = StructType([f for f in customers.schema.fields if f.name != "c_name"]).add("c_email", "string")
    counted = customers.agg(F.count(F.lit(1)))
    return schema_drift(customers, declared).select("column_name", "change", counted.scalar().alias("row_count"))


@query
def csv_extract(spark, sf_dir):
    """Accounts written as CSV and read by the typed loader."""
    path = scratch_path(spark, "accounts-csv")
    domain.accounts(spark, sf_dir).drop("_source_system").write.option("header", True).option(
        "escape", '"'
    ).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return read_csv(spark, path, schemas.ACCOUNTS)


def _run_documents(spark, sf_dir):
    """One run document per order, landed as lines: two nodes, one of them without a message."""
    path = scratch_path(spark, "run-results")
    n = F.col("o_orderkey")

    def node(name, seconds, affected, message):
        return F.struct(
            F.concat(F.lit(f"model.shop.{name}_"), n.cast("string")).alias("unique_id"),
            F.when(F.col("o_orderstatus") == "F", "success").otherwise("error").alias("status"),
            seconds.alias("execution_time"),
            F.struct(affected.alias("rows_affected")).alias("adapter_response"),
            message.alias("message"),
        )

    documents = table(spark, sf_dir, "orders").select(
        F.struct(
            F.concat(F.lit("run_"), n.cast("string")).alias("invocation_id"), F.lit("1.8.0").alias("dbt_version")
        ).alias("metadata"),
        F.array(
            node("stg", F.col("o_totalprice"), n, F.col("o_orderpriority")),
            node("fct", F.lit(1.5), F.lit(None).cast("bigint"), F.lit(None).cast("string")),
        ).alias("results"),
    )
    documents.write.json(path)
    return path


@query
def run_results_explode(spark, sf_dir):
    read = read_run_results(spark, _run_documents(spark, sf_dir), multi_line=False)
    return ingest.run_result_rows(read, "2024-11-01", datetime(2024, 11, 1))


@query
def run_results_recorded(spark, sf_dir):
    """The same documents appended to the monitoring table by two runs."""
    path = _run_documents(spark, sf_dir)
    for day in ("2024-11-01", "2024-11-02"):
        ingest.record_run_results(spark, path, f"{path}-monitoring", day, multi_line=False)
    return spark.read.parquet(f"{path}-monitoring").drop("pipeline_run_at")


@query
def ingest_guard(spark, sf_dir):
    """An extract without records is refused and leaves the raw table as it was."""
    path, refused = scratch_path(spark, "guard"), 0
    payload = _payload(spark, sf_dir)
    payload.write.json(f"{path}/landed")
    ingest.ingest_subscriptions(spark, f"{path}/landed", f"{path}/raw", "2024-11-01")
    payload.limit(0).write.json(f"{path}/none")
    for schema in (None, payload.schema):
        try:
            ingest.ingest_subscriptions(spark, f"{path}/none", f"{path}/raw", "2024-11-02", schema)
        except ValueError:
            refused += 1
    held = spark.read.parquet(f"{path}/raw")
    return held.agg(F.count(F.lit(1)).alias("row_count"), F.lit(refused).alias("refused"))


@query
def seed_load(spark, sf_dir):
    """Every source table as a CSV extract, loaded as the typed raw tables."""
    path = scratch_path(spark, "seeds")
    events = domain.usage_events(spark, sf_dir)
    extracts = {
        "accounts": domain.accounts(spark, sf_dir),
        "users": events.select("user_id", "account_id").distinct(),
        "subscriptions": domain.raw_subscriptions(spark, sf_dir).withColumn("amount", F.col("amount").try_cast("int")),
        "usage_events": events,
        "invoices": domain.invoices(spark, sf_dir),
        "invoice_line_items": domain.invoice_line_items(spark, sf_dir),
    }
    for name, rows in extracts.items():
        writer = rows.write.option("header", True).option("escape", '"')
        writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{path}/raw_{name}.csv")
    ingest.land_extracts(spark, path, f"{path}/base")
    loaded = {name: spark.read.parquet(f"{path}/base/raw_{name}") for name in extracts}
    # Sums of milliseconds leave 64 bits at some five million events.
    wide = "decimal(38,0)"
    sums = {
        "accounts": F.count("is_active"), "users": F.count("account_id"),
        **{n: F.sum(F.col(c).cast(wide)) for n, c in {
            "subscriptions": "amount", "usage_events": "event_timestamp", "invoices": "total_cents", "invoice_line_items": "total_cents",
        }.items()},
    }
    parts = [rows.agg(F.count(F.lit(1)).alias("row_count"), sums[n].cast(wide).alias("checksum")).withColumn("table_name", F.lit(n)) for n, rows in loaded.items()]
    totals = reduce(DataFrame.unionByName, parts)
    totals.write.parquet(f"{path}/totals")
    held = spark.read.schema(totals.schema).parquet(f"{path}/totals")
    # Bigint while every sum is one, the exact wide number otherwise.
    small = F.col("checksum").try_cast("bigint")
    if held.where(F.col("checksum").isNotNull() & small.isNull()).isEmpty():
        return held.withColumn("checksum", small)
    return held


@query
def day_arguments(spark, sf_dir):
    """Which texts count as a day, among order dates written in five ways."""
    day, way = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 5
    text = (
        F.when(way == 0, day).when(way == 1, F.replace(day, F.lit("-"), F.lit("/"))).when(way == 2, F.concat(day, F.lit(" ")))
        .when(way == 3, F.concat(F.substring(day, 1, 8), F.lit("31"))).otherwise(F.concat(F.substring(day, 1, 5), F.lit("13-01")))
    )
    rows = table(spark, sf_dir, "orders").select(way.alias("way"), strict_day(text).alias("day"))
    return rows.groupBy("way").agg(F.count(F.lit(1)).alias("row_count"), F.count("day").alias("days"), F.max("day").alias("latest"))


# --- streaming --------------------------------------------------------------


TRUNCATED = '{"event_id": '
TRIGGERS = 6
# One task reads a landed file, so a trigger gets several of about this many messages.
FILE_MESSAGES = 100_000


def _landed_messages(spark, sf_dir):
    """Events as broker records on disk.

    One in fifty has a truncated body, and those without an account lack a required field.
    """
    path = scratch_path(spark, "messages")
    events = domain.usage_events(spark, sf_dir)
    broken = F.floor(F.col("_kafka_offset") / 2) % 50 == 0
    events.select(
        F.col("account_id").cast("binary").alias("key"),
        F.when(broken, F.lit(TRUNCATED).cast("binary"))
        .otherwise(decode.record_body())
        .alias("value"),
        F.lit("usage").alias("topic"),
        F.col("_kafka_partition").alias("partition"),
        F.col("_kafka_offset").cast("bigint").alias("offset"),
        F.col("_loaded_at").alias("timestamp"),
    ).write.parquet(path)
    return path


def _files_of(messages: int) -> int:
    return max(1, messages // FILE_MESSAGES)


def _drained(spark, sf_dir, start):
    """A stream over several triggers with a restart after half of the messages.

    Both copies of an event lie in one file, the way a broker partition delivers them.
    """
    path = scratch_path(spark, "lake")
    messages = spark.read.schema(decode.MESSAGE_SCHEMA).parquet(_landed_messages(spark, sf_dir))
    pair = F.floor(F.col("offset") / 2)
    for half in range(2):
        files = messages.where(pair % 2 == half).repartition(4, "partition", pair)
        files.write.mode("append").parquet(f"{path}/in")
        stream = decode.decode_messages(decode.read_landed_messages(spark, f"{path}/in", max_files=2))
        start(stream, path, f"{path}/_checkpoint", None).awaitTermination()
    return path


@query
def stream_lake(spark, sf_dir):
    """Events that went through the stream, read back from the lake."""
    path = _drained(spark, sf_dir, lake.events_to_lake)
    landed = spark.read.parquet(f"{path}/events")
    return landed.select(*lake.EVENT_COLUMNS, "_kafka_offset", "_kafka_partition", "_kafka_timestamp")


@query
def stream_lake_manifest(spark, sf_dir):
    path = _drained(spark, sf_dir, lake.events_to_lake)
    return spark.read.parquet(f"{path}/_batches").agg(
        F.sum("record_count").alias("record_count"),
        F.min("min_event_timestamp").alias("min_event_timestamp"),
        F.max("max_event_timestamp").alias("max_event_timestamp"),
    )


@query
def stream_quarantine(spark, sf_dir):
    path = _drained(spark, sf_dir, lake.events_to_lake)
    bad = spark.read.parquet(f"{path}/_undecoded")
    truncated = F.col("_undecoded").cast("string") == TRUNCATED
    return bad.select(truncated.alias("truncated"), "_kafka_offset", "_kafka_partition")


@query
def stream_raw_event_mix(spark, sf_dir):
    """Events through the stream into the raw table, then counts over that table.

    The load time of a stream is its trigger time, so the broker position decides
    between copies.
    """
    path = _drained(spark, sf_dir, lake.events_to_raw)
    return usage.event_type_mix(spark.read.parquet(f"{path}/events"))


@query
def stream_dedup(spark, sf_dir):
    """Events whose second copy was dropped while streaming."""
    path, messages = scratch_path(spark, "dedup"), _landed_messages(spark, sf_dir)
    # Files in shuffled order, as many for each of six triggers: copies and late events meet across batches.
    shuffled, landed = f"{path}/messages", spark.read.parquet(messages)
    files = _files_of(landed.count() // TRIGGERS)
    landed.repartition(TRIGGERS * files, F.xxhash64("value", "offset")).write.parquet(shuffled)
    decoded = decode.decode_messages(decode.read_landed_messages(spark, shuffled, max_files=files)).where("_decoded")
    lake.drop_redelivered(decoded).select("event_id", "event_timestamp").writeStream.format(
        "parquet"
    ).option("path", f"{path}/out").option("checkpointLocation", f"{path}/_checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def stream_dedup_bounded(spark, sf_dir):
    """The same with state that expires: six triggers in the order of arrival, copies a day apart."""
    path = scratch_path(spark, "dedup-bounded")
    messages = spark.read.schema(decode.MESSAGE_SCHEMA).parquet(_landed_messages(spark, sf_dir))
    arrived = F.unix_seconds("timestamp")
    bounds = messages.agg(F.min(arrived).alias("a"), F.max(arrived).alias("b")).first()
    slot = F.least(F.floor((arrived - bounds["a"]) * TRIGGERS / (bounds["b"] - bounds["a"] + 1)), F.lit(TRIGGERS - 1))
    # Every trigger takes the files of one slot, so all have as many; the smallest fills each of its own.
    held = {r[0]: r[1] for r in messages.groupBy(slot.cast("int")).count().collect() if r[0] is not None}
    files = _files_of(min(held.values()))
    for n in sorted(held):
        dealt = messages.where(slot == n).repartition(files, F.xxhash64("value", "offset"))
        dealt.write.mode("append").parquet(f"{path}/in")
    decoded = decode.decode_messages(decode.read_landed_messages(spark, f"{path}/in", max_files=files)).where("_decoded")
    lake.drop_redelivered_within(decoded, "2 days").select("event_id", "event_timestamp").writeStream.format(
        "parquet"
    ).option("path", f"{path}/out").option("checkpointLocation", f"{path}/_checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def stream_lake_timed(spark, sf_dir):
    """The stream on its time trigger, stopped when it has caught up."""
    path = scratch_path(spark, "lake-timed")
    messages = decode.read_landed_messages(spark, _landed_messages(spark, sf_dir), max_bytes=200_000)
    running = lake.events_to_lake(decode.decode_messages(messages), path, f"{path}/_checkpoint", 1)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    landed = spark.read.parquet(f"{path}/events")
    return landed.select(*lake.EVENT_COLUMNS, "_kafka_offset", "_kafka_partition", "_kafka_timestamp")


@query
def keyed_messages(spark, sf_dir):
    records = decode.keyed_messages(usage.latest_events(domain.usage_events(spark, sf_dir)))
    decoded = records.select(
        F.col("key").cast("string").alias("message_key"), decode.decode_json(F.col("value")).alias("event")
    )
    return decoded.select("message_key", "event.event_id", "event.event_timestamp", "event.metadata")
