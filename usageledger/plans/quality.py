"""Quality suites: declared tests per model, and the daily layer checks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger import fixed_values as fv
from usageledger.functions.columns import moment, relative_gap, whole_units_between
from usageledger.operators.checks import (
    Check,
    accepted,
    length_is,
    never,
    not_null,
    run_checks,
    unique,
    unique_together,
    within,
)
from usageledger.sources.tables import loaded_between, parse_day


def _required(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


def declared_checks() -> dict[str, list[Check]]:
    """The tests every model must pass."""
    statuses = accepted("subscription_status", fv.KNOWN_STATUSES)
    intervals = accepted("billing_interval", [*fv.BILLING_INTERVALS, None])
    currency = length_is("currency", fv.CURRENCY_LENGTH)
    subscription = ["subscription_id", "account_id", "plan_id", "subscription_status",
                    "currency", "mrr_amount", "started_at"]
    return {
        "raw_accounts": [unique("account_id"), not_null("account_id")],
        "raw_subscriptions": [not_null("id")],
        "stg_subscriptions": [
            unique("subscription_id"), statuses, intervals, currency,
            *_required(*subscription, "_source_system", "_loaded_at"),
        ],
        "snap_accounts": [unique("dbt_scd_id"), *_required("account_id", "dbt_scd_id")],
        "int_account_metrics": [
            unique("account_id"),
            *_required("account_id", "account_sk", "total_subscriptions"),
        ],
        "int_plan_metrics": [unique("plan_id"), *_required("plan_id", "total_subscriptions")],
        "fct_subscriptions": [
            unique("subscription_sk"), unique("subscription_id"), statuses, intervals, currency,
            within("mrr_amount", *fv.MRR_RANGE),
            *_required("subscription_sk", "account_sk", *subscription, "_source_system",
                       "_loaded_at"),
            negative_mrr_check(),
        ],
        "rpt_subscription_monthly": [
            unique_together("snapshot_month", "subscription_id"),
            statuses, currency,
            accepted("health_status", sorted({*fv.HEALTH_LABELS.values(), "Other"})),
            accepted("value_tier", [label for _, label in fv.VALUE_TIERS]
                     + [fv.VALUE_TIER_FLOOR, fv.VALUE_TIER_NONE]),
            accepted("billing_type", [*fv.BILLING_LABELS.values(), "Other"]),
            *_required("snapshot_month", *subscription),
        ],
        "rpt_account_overview": [
            unique("account_id"),
            accepted("account_health_segment", fv.ACCOUNT_SEGMENTS),
            accepted("product_adoption", [label for _, label in fv.ADOPTION_BY_PRODUCTS]
                     + [fv.ADOPTION_NONE]),
            accepted("engagement_status", ["New", fv.ENGAGEMENT_OLD, None]
                     + [label for _, label in fv.ENGAGEMENT_BY_DAYS]),
            *_required("account_id", "total_subscriptions", "active_subscriptions",
                       "cancelled_subscriptions", "trialing_subscriptions", "total_mrr",
                       "total_arr", "unique_plans_subscribed", "currencies_used",
                       "account_health_segment", "product_adoption", "account_age_days"),
        ],
    }


def negative_mrr_check() -> Check:
    return never(
        "active_with_negative_mrr",
        (F.col("subscription_status") == "active") & (F.col("mrr_amount") < 0),
    )


def check_models(models: Mapping[str, DataFrame]) -> DataFrame:
    """Results of the declared tests for the given models."""
    declared = declared_checks()
    return reduce(
        DataFrame.unionByName,
        [run_checks(rows, declared[name], name) for name, rows in models.items()],
    )




def _judged(measured: Column, limit: float) -> Column:
    """An empty input is neither good nor bad."""
    return (
        F.when(measured.isNull(), "no_data").when(measured > limit, "fail").otherwise("pass")
    )


def volume_anomaly(
    raw: DataFrame, ds: str | date, lookback: int = fv.VOLUME_LOOKBACK_DAYS
) -> DataFrame:
    """Rows loaded on `ds` against the mean of the days before it; absent days don't count."""
    day = parse_day(ds)
    daily = (
        loaded_between(raw, day - timedelta(days=lookback), day)
        .groupBy(F.to_date("_loaded_at").alias("d"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stats = daily.agg(
        F.max(F.when(F.col("d") == F.lit(day), F.col("n"))).alias("today"),
        F.avg(F.when(F.col("d") < F.lit(day), F.col("n"))).alias("prior_mean"),
    )
    deviation = relative_gap("today", "prior_mean")
    return stats.select(
        "today",
        "prior_mean",
        deviation.alias("deviation"),
        _judged(deviation, fv.VOLUME_LIMIT).alias("status"),
    )


def mrr_reconciliation(staged: DataFrame, facts: DataFrame, ds: str | date | None = None) -> DataFrame:
    """Active revenue of two layers, for one load day or for all of them."""
    def layer(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.where(F.col("subscription_status") == "active")
        if ds is not None:
            rows = loaded_between(rows, ds, ds)
        return rows.select(F.lit(name).alias("layer"), "mrr_amount")

    both = layer(staged, "staging").unionByName(layer(facts, "transform"))
    totals = both.agg(*[
        F.sum(F.when(F.col("layer") == name, F.col("mrr_amount"))).cast("double").alias(f"{name}_mrr")
        for name in ("staging", "transform")
    ])
    gap = relative_gap("transform_mrr", "staging_mrr")
    return totals.select(
        "*", gap.alias("diff"), _judged(gap, fv.RECONCILIATION_LIMIT).alias("status")
    )


def freshness(
    rows: DataFrame, column: str, as_of: datetime | Column | None = None,
    limit_hours: int = fv.FRESHNESS_LIMIT_HOURS,
) -> DataFrame:
    """Whole hours since the newest row."""
    newest = rows.agg(F.max(column).alias("newest"))
    hours = whole_units_between("HOUR", "newest", moment(as_of))
    return newest.select(
        "newest", hours.alias("hours_old"), _judged(hours, limit_hours).alias("status")
    )


def quality_suite(
    raw: DataFrame,
    staged: DataFrame,
    facts: DataFrame,
    reports: Mapping[str, tuple[DataFrame, str]],
    ds: str | date,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """One row per check; `reports` maps a name to a table and its timestamp column."""
    def row(result: DataFrame, name: str, measured: str, limit: float) -> DataFrame:
        return result.select(
            F.lit(name).alias("check_name"),
            F.col(measured).cast("double").alias("measured"),
            F.lit(float(limit)).alias("threshold"),
            "status",
        )

    parts = [
        row(volume_anomaly(raw, ds), "row_volume", "deviation", fv.VOLUME_LIMIT),
        row(mrr_reconciliation(staged, facts, ds), "mrr_reconciliation", "diff",
            fv.RECONCILIATION_LIMIT),
    ]
    for name, (rows, column) in reports.items():
        parts.append(row(freshness(rows, column, as_of), f"freshness_{name}", "hours_old",
                         fv.FRESHNESS_LIMIT_HOURS))
    return reduce(DataFrame.unionByName, parts)


def graded(value: Column, limits: tuple[int, int]) -> Column:
    """healthy below the first limit, warning up to the second, critical above."""
    return (
        F.when(value < limits[0], "healthy")
        .when(value <= limits[1], "warning")
        .when(value > limits[1], "critical")
    )


def lag_status(offsets: DataFrame) -> DataFrame:
    """Consumer lag per topic from `topic, partition, log_end_offset, current_offset`."""
    lag = offsets.groupBy("topic").agg(
        F.sum(F.col("log_end_offset") - F.col("current_offset")).alias("total_lag")
    )
    return lag.withColumn("status", graded(F.col("total_lag"), fv.LAG_LIMITS))


def layer_age(rows: DataFrame, column: str, limits: tuple[int, int], as_of: datetime | Column) -> DataFrame:
    """Minutes since a layer last received rows, graded."""
    minutes = whole_units_between("MINUTE", F.max(column), moment(as_of))
    aged = rows.agg(minutes.alias("minutes_old"))
    return aged.withColumn("status", graded(F.col("minutes_old"), limits))
