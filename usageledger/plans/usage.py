"""Usage events to daily account metrics."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger import fixed_values as fv
from usageledger.functions.columns import millis_to_date, tidy
from usageledger.operators.dedup import keep_latest
from usageledger.schemas import EVENT_METADATA
from usageledger.session import pin_utc, scratch_path
from usageledger.sinks.files import dry_run as preview_write
from usageledger.sinks.files import drop_folder, drop_partitions, exists, partition_folders, write_partitioned
from usageledger.sources.tables import day_range, loaded_between, parse_day, read_events

GRAIN = ["event_date", "account_id", "event_type", "feature_name"]
CLUSTER = ["account_id", "event_type"]
MEASURED = [
    "event_id", "account_id", "user_id", "event_type", "feature_name", "session_id",
    "event_timestamp", "_loaded_at",
]
BATCH_FOLDER = "batch_day"
# Where the broker position is known it settles equal load times.
POSITION = ["_kafka_partition", "_kafka_offset"]


def _needed(events: DataFrame, *more: str) -> DataFrame:
    position = [c for c in POSITION if c in events.columns]
    return events.select(*MEASURED, *position, *more)


def latest_events(events: DataFrame, *within: str) -> DataFrame:
    """One copy per event id: the last one loaded.

    Rows without an id go first, they can only end up dropped. Rows without an account
    go after: if the last copy lost its account, the event is dropped, not revived from
    an older copy. Of copies that cannot be told apart otherwise the one with the latest
    event time counts.
    """
    identified = events.where(F.col("event_id").isNotNull())
    return keep_latest(identified, [*within, "event_id"], _newest(events))


def _newest(events: DataFrame) -> list[str]:
    position = [c for c in POSITION if c in events.columns]
    return ["_loaded_at", *position, "event_timestamp"]


def latest_inside(inside: DataFrame, outside: DataFrame) -> DataFrame:
    """The latest copies that are rows of `inside`; `outside` holds the events of all other days.

    A copy outside matters only where it is later than those inside. Outside rows are
    shuffled without the columns that the metrics read, and only one per event that has
    a copy inside meets the inside rows.
    """
    rivals = latest_events(outside.select("event_id", *_newest(outside)))
    rivals = rivals.join(inside.select("event_id").distinct(), "event_id", "left_semi")
    both = inside.withColumn("_inside", F.lit(True)).unionByName(
        rivals.withColumn("_inside", F.lit(False)), allowMissingColumns=True
    )
    return latest_events(both).where("_inside").drop("_inside")


def clean_events(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "event_date": millis_to_date("event_timestamp"),
        "event_type": tidy("event_type"),
        "feature_name": tidy("feature_name"),
    }).where(F.col("account_id").isNotNull() & F.col("event_id").isNotNull())


def daily_metrics(events: DataFrame, *within: str) -> DataFrame:
    """Counts per day, account, type and feature.

    Spark computes the two exact distinct counts by first shuffling on the grain plus
    the user or session, so a hot account is spread over its users and sessions, and
    aggregates before each of its shuffles.
    """
    return events.groupBy(*within, *GRAIN).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.min("event_timestamp").alias("first_event_ts"),
        F.max("event_timestamp").alias("last_event_ts"),
    )


def _stamped(metrics: DataFrame, source: str) -> DataFrame:
    return metrics.withColumns(
        {"_processed_at": F.current_timestamp(), "_source": F.lit(source)}
    )


def usage_daily(events: DataFrame, processing_date: str | date | None = None) -> DataFrame:
    """Daily metrics of the events loaded on `processing_date`, or of all of them."""
    if processing_date is not None:
        events = loaded_between(events, processing_date, processing_date)
    cleaned = clean_events(latest_events(_needed(events)))
    return _stamped(daily_metrics(cleaned), fv.BATCH_SOURCE)


def batch_number(day: Column, first: date, batch_days: int) -> Column:
    """Which run of `batch_days` days, counted from `first`, a day falls in."""
    return F.floor(F.datediff(day, F.lit(first)) / F.lit(batch_days)).cast("int")


def batch_bounds(number: Column, first: date, last: date, batch_days: int) -> dict[str, Column]:
    """First and last day of a batch as text; the last batch may be shorter."""
    opens = F.date_add(F.lit(first), number * F.lit(batch_days))
    closes = F.least(F.date_add(opens, batch_days - 1), F.lit(last))
    return {"_batch_start": opens.cast("string"), "_batch_end": closes.cast("string")}


def usage_backfill(
    events: DataFrame, first: str | date, last: str | date, batch_days: int = 1
) -> DataFrame:
    """Metrics per batch of load days, every batch deduplicated on its own.

    All batches run in one plan: the batch number is one more grouping column, so a long
    range is one shuffle over the cluster, not a sequence of small jobs.
    """
    if batch_days < 1:
        raise ValueError("batch_days must be at least 1")
    start, end = day_range(first, last)
    ranged = _needed(loaded_between(events, start, end)).withColumn(
        "_batch", batch_number(F.to_date("_loaded_at"), start, batch_days)
    )
    cleaned = clean_events(latest_events(ranged, "_batch"))
    metrics = _stamped(daily_metrics(cleaned, "_batch"), fv.BACKFILL_SOURCE)
    return metrics.withColumns(batch_bounds(F.col("_batch"), start, end, batch_days)).drop("_batch")


def affected_days(events: DataFrame, load_day: str | date, last: str | date | None = None) -> DataFrame:
    """The event days of every event loaded on `load_day` (to `last`), days that it has left included."""
    arrived = loaded_between(events, load_day, last or load_day).select("event_id").distinct()
    # One row per event and day first: copies of one event must not meet in one task.
    days_of = _needed(events).select("event_id", millis_to_date("event_timestamp").alias("event_date"))
    return days_of.distinct().join(arrived, "event_id", "left_semi").select("event_date").distinct()


def recompute_days(
    events: DataFrame,
    load_day: str | date,
    timestamps_final: bool = False,
    last: str | date | None = None,
    source: str = fv.BATCH_SOURCE,
    affected: DataFrame | None = None,
) -> DataFrame:
    """Full metrics of every event day that an event loaded on `load_day` (to `last`) belongs to.

    Distinct counts of two load days cannot be added up, so each affected event day is
    computed again from all of its events. An event whose timestamp was corrected
    affects the day it left as well. Where copies of an event never differ in their
    timestamp, say so with `timestamps_final`: other days are then not looked at. `affected`
    holds the days where they are known already.
    """
    dated = _needed(events).withColumn("event_date", millis_to_date("event_timestamp"))
    if affected is None:
        affected = affected_days(events, load_day, last)
    # One row per calendar day, however large the table. Events without a time have a day too: NULL.
    days = F.broadcast(affected.select(F.col("event_date").alias("_day")))
    touched = F.col("event_date").eqNullSafe(F.col("_day"))
    latest = inside = dated.join(days, touched, "left_semi")
    if timestamps_final:
        latest = latest_events(inside)
    else:
        latest = latest_inside(inside, dated.join(days, touched, "left_anti"))
    return _stamped(daily_metrics(clean_events(latest)), source)


@contextmanager
def _kept_days(days: DataFrame) -> Iterator[DataFrame]:
    """The days, found once."""
    spark = days.sparkSession
    kept = scratch_path(spark, "usage-touched")
    days.write.parquet(kept)
    yield spark.read.schema(days.schema).parquet(kept)
    drop_folder(spark, kept)


def _replace_days(spark: SparkSession, metrics: DataFrame, path: str, touched: DataFrame) -> int:
    """Write the metrics and drop touched days that have no events any more.

    The metrics are staged first, so a run that dies is finished by running it again.
    One row per calendar day reaches the driver.
    """
    staged = scratch_path(spark, "usage-days")
    metrics.write.parquet(staged)
    result = spark.read.schema(metrics.schema).parquet(staged)
    filled = {r[0] for r in result.select("event_date").distinct().collect()}
    emptied = {r[0] for r in touched.collect()} - filled
    rows = write_partitioned(result, path, "event_date", CLUSTER, ranged=True) if filled else 0
    drop_partitions(spark, path, "event_date", emptied)
    drop_folder(spark, staged)
    return rows


def event_type_mix(events: DataFrame) -> DataFrame:
    """Events and distinct accounts per type."""
    cleaned = clean_events(latest_events(_needed(events)))
    return cleaned.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("account_id").alias("unique_accounts"),
    )


def read_metadata(events: DataFrame, schema: Any = EVENT_METADATA) -> DataFrame:
    """The JSON metadata as columns; text that is no JSON gives NULLs."""
    fields = F.from_json("metadata", schema)
    return events.select("*", fields.alias("_meta")).select(*events.columns, "_meta.*")


def _raw_events(spark: SparkSession, path: str, loaded_since: str | date | None = None) -> DataFrame:
    """The raw table, or only what was loaded from a day on.

    A bound prunes load-date folders. It is right only if no older load holds copies of
    the events in question, for example because events are never loaded before they
    happen; without one, all of the raw table counts.
    """
    pin_utc(spark)
    events = read_events(spark, path)
    return events if loaded_since is None else loaded_between(events, loaded_since, date.max - timedelta(days=1))


def run_usage_daily(
    spark: SparkSession,
    raw_path: str,
    target_path: str,
    processing_date: str | date | None = None,
    recompute: bool = True,
    timestamps_final: bool = False,
    loaded_since: str | date | None = None,
) -> int:
    """The daily job: yesterday by default, one write, rows counted while writing.

    The event days that the load touches are replaced, and a day that all its events
    have left is dropped. `recompute=False` writes the metrics of the load day alone,
    which forgets earlier loads of the same event days. Days are UTC, the default too.
    """
    day = parse_day(processing_date) if processing_date else datetime.now(timezone.utc).date() - timedelta(days=1)
    events = _raw_events(spark, raw_path, loaded_since)
    if not recompute:
        return write_partitioned(usage_daily(events, day), target_path, "event_date", CLUSTER)
    with _kept_days(affected_days(events, day)) as touched:
        metrics = recompute_days(events, day, timestamps_final, affected=touched)
        return _replace_days(spark, metrics, target_path, touched)


def run_usage_backfill(
    spark: SparkSession,
    raw_path: str,
    target_path: str,
    first: str,
    last: str,
    batch_days: int = 1,
    dry_run: bool = False,
    append: bool = False,
    recompute: bool = True,
) -> dict[str, Any]:
    """The range job.

    By default it shares its table with the daily job: the event days that the range's
    loads touch are computed again from all loads and replaced, so nothing that other
    loads brought is lost. `recompute=False` or `append` writes the metrics per batch of
    load days instead, to a table of their own foldered by `batch_day`, the first day of
    the batch; a repeat replaces its batches unless `append` is asked for.
    """
    start, end = day_range(first, last)
    events = _raw_events(spark, raw_path)
    if recompute and not append:
        with _kept_days(affected_days(events, start, end)) as touched:
            metrics = recompute_days(events, start, last=end, source=fv.BACKFILL_SOURCE, affected=touched)
            if dry_run:
                return preview_write(metrics)
            return {"rows": _replace_days(spark, metrics, target_path, touched)}
    metrics = usage_backfill(events, start, end, batch_days)
    if dry_run:
        return preview_write(metrics)
    if partition_folders(spark, target_path, "event_date"):
        raise ValueError(f"{target_path} holds daily metrics; batches need a table of their own")
    foldered = metrics.withColumn(BATCH_FOLDER, F.to_date("_batch_start"))
    return {"rows": write_partitioned(foldered, target_path, BATCH_FOLDER, CLUSTER, append)}


def recent_days(events: DataFrame, as_of: str | date, days: int = fv.LOOKBACK_DAYS) -> DataFrame:
    """Metrics of the event days from `days` days before `as_of` on."""
    oldest = parse_day(as_of) - timedelta(days=days)
    # Compared with the bare column, so that the bound reaches the scan.
    opens = int(datetime(oldest.year, oldest.month, oldest.day, tzinfo=timezone.utc).timestamp()) * 1000
    narrow, recent = _needed(events), F.col("event_timestamp") >= F.lit(opens)
    latest = latest_inside(narrow.where(recent), narrow.where(~F.coalesce(recent, F.lit(False))))
    return _stamped(daily_metrics(clean_events(latest)), fv.BATCH_SOURCE)


def run_recent_days(
    spark: SparkSession,
    raw_path: str,
    target_path: str,
    as_of: str | date,
    days: int = fv.LOOKBACK_DAYS,
    loaded_since: str | date | None = None,
) -> int:
    """Compute the recent event days again and replace them; days left empty are dropped."""
    metrics = recent_days(_raw_events(spark, raw_path, loaded_since), as_of, days)
    oldest = parse_day(as_of) - timedelta(days=days)
    there = spark.createDataFrame([], "event_date date")
    if exists(spark, target_path):
        there = spark.read.parquet(target_path).select(F.col("event_date").cast("date").alias("event_date"))
    return _replace_days(spark, metrics, target_path, there.where(F.col("event_date") >= F.lit(oldest)).distinct())
