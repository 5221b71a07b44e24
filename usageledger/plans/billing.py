"""Subscriptions: staging, facts, account and plan metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger import fixed_values as fv
from usageledger.functions.columns import (
    MONEY,
    annualised,
    cents_to_units,
    seconds_to_timestamp,
    surrogate_key,
    tidy,
)
from usageledger.operators.dedup import keep_latest
from usageledger.operators.history import current_versions
from usageledger.operators.lookup import lookup

RAW_COLUMNS = [
    "id", "customer", "plan_id", "status", "billing_interval", "currency", "amount", "created",
    "canceled_at", "ended_at", "trial_start", "trial_end", "_source_system", "_loaded_at",
    "_pipeline_run_date",
]
FACT_COLUMNS = [
    "subscription_sk", "subscription_id", "account_id", "account_sk", "plan_id",
    "subscription_status", "billing_interval", "currency", "mrr_amount", "arr_amount",
    "started_at", "cancelled_at", "ended_at", "trial_start_at", "trial_end_at",
    "_source_system", "_loaded_at",
]


def stg_subscriptions(
    raw: DataFrame,
    status_aliases: Mapping[str, str] | None = None,
    normalize_interval: bool = False,
) -> DataFrame:
    """The last loaded copy of every subscription, typed and cleaned.

    A flattened payload carries the account as `customer_id` instead of `customer`.
    By default the amount counts as monthly whatever the interval; `normalize_interval`
    divides yearly amounts by twelve. `status_aliases` maps foreign spellings.
    """
    if "customer_id" in raw.columns:
        named = F.coalesce("customer", "customer_id") if "customer" in raw.columns else F.col("customer_id")
        raw = raw.withColumn("customer", named)
    identified = raw.select(*RAW_COLUMNS).where(F.col("id").isNotNull())
    latest = keep_latest(identified, ["id"], ["_loaded_at"])

    status = tidy("status")
    for alias, name in (status_aliases or {}).items():
        status = F.when(status == alias, name).otherwise(status)
    interval, amount = tidy("billing_interval"), cents_to_units("amount")
    if normalize_interval:
        yearly = (amount / F.lit(fv.MONTHS_PER_YEAR)).cast(MONEY)
        amount = F.when(interval == "year", yearly).otherwise(amount)
    return latest.where(F.col("customer").isNotNull()).select(
        F.col("id").alias("subscription_id"),
        F.col("customer").alias("account_id"),
        "plan_id",
        status.alias("subscription_status"),
        interval.alias("billing_interval"),
        tidy("currency", upper=True).alias("currency"),
        amount.alias("mrr_amount"),
        # Zero is a real start time, but "unset" for all the others.
        seconds_to_timestamp("created", zero_means_unset=False).alias("started_at"),
        seconds_to_timestamp("canceled_at").alias("cancelled_at"),
        seconds_to_timestamp("ended_at").alias("ended_at"),
        seconds_to_timestamp("trial_start").alias("trial_start_at"),
        seconds_to_timestamp("trial_end").alias("trial_end_at"),
        "_source_system",
        "_loaded_at",
        "_pipeline_run_date",
    )


def fct_subscriptions(
    staged: DataFrame, accounts: DataFrame, hot_accounts: DataFrame | None = None
) -> DataFrame:
    """Staged subscriptions with keys, yearly revenue and their account's current version.

    `hot_accounts` are the accounts that own so many subscriptions that their join has
    to be split; see `operators.lookup.hot_keys`.
    """
    versions = current_versions(accounts).select(
        "account_id", F.col("dbt_scd_id").alias("account_sk")
    )
    joined = lookup(staged, versions, "account_id", ["subscription_id"], hot_accounts)
    return joined.withColumns({
        "subscription_sk": surrogate_key("subscription_id"),
        "arr_amount": annualised("mrr_amount"),
    }).select(*FACT_COLUMNS)


def _in_status(*names: str) -> Column:
    return F.col("subscription_status").isin(*names)


def _count_of(*names: str) -> Column:
    return F.count_if(_in_status(*names))


def _active_sum(amount: str) -> Column:
    return F.sum(F.when(_in_status("active"), F.col(amount)).otherwise(F.lit(0).cast(MONEY)))


def _lifecycle_counts() -> list[Column]:
    counts = [F.count(F.lit(1)).alias("total_subscriptions")]
    counts += [
        _count_of(name).alias(f"{name}_subscriptions")
        for name in ("active", "cancelled", "trialing")
    ]
    return counts


def _start_range() -> list[Column]:
    return [
        F.min("started_at").alias("first_subscription_at"),
        F.max("started_at").alias("latest_subscription_at"),
    ]


def account_metrics(facts: DataFrame) -> DataFrame:
    """One row per account and account version."""
    return facts.groupBy("account_id", "account_sk").agg(
        *_lifecycle_counts(),
        _active_sum("mrr_amount").alias("total_active_mrr"),
        _active_sum("arr_amount").alias("total_active_arr"),
        *_start_range(),
        F.count_distinct("plan_id").alias("unique_plans"),
        F.count_distinct("currency").alias("unique_currencies"),
    )


def plan_metrics(facts: DataFrame) -> DataFrame:
    """One row per plan. Only active subscriptions enter the average."""
    return facts.groupBy("plan_id").agg(
        *_lifecycle_counts(),
        _count_of(*fv.AT_RISK_STATUSES).alias("at_risk_subscriptions"),
        _active_sum("mrr_amount").alias("plan_active_mrr"),
        _active_sum("arr_amount").alias("plan_active_arr"),
        F.avg(F.when(_in_status("active"), F.col("mrr_amount"))).alias("avg_active_mrr"),
        F.count_distinct("account_id").alias("unique_accounts"),
        *_start_range(),
    )


def mrr_by_status(facts: DataFrame) -> DataFrame:
    return facts.groupBy("subscription_status").agg(
        F.count(F.lit(1)).alias("subscription_count"),
        F.round(F.sum("mrr_amount"), 2).alias("total_mrr"),
    )
