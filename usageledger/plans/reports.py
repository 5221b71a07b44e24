"""Reporting tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger import fixed_values as fv
from usageledger.functions.columns import (
    banded,
    capped,
    labelled,
    moment,
    month_of,
    whole_units_between,
)
from usageledger.operators.history import current_versions
from usageledger.operators.lookup import lookup

MONTHLY_ATTRIBUTES = ["account_name", "industry", "company_size_band", "region", "account_tier"]
OVERVIEW_ATTRIBUTES = [*MONTHLY_ATTRIBUTES, "csm_user_id"]


def subscription_monthly(
    facts: DataFrame, accounts: DataFrame, hot_accounts: DataFrame | None = None
) -> DataFrame:
    """One row per subscription, in the month it started."""
    attributes = current_versions(accounts).select("account_id", *MONTHLY_ATTRIBUTES)
    is_active = F.col("subscription_status") == "active"
    tier = banded(F.col("mrr_amount"), fv.VALUE_TIERS, fv.VALUE_TIER_FLOOR)
    return lookup(facts, attributes, "account_id", ["subscription_id"], hot_accounts).select(
        month_of("started_at").alias("snapshot_month"),
        "subscription_id", "account_id", *MONTHLY_ATTRIBUTES, "plan_id", "subscription_status",
        "billing_interval", "currency", "mrr_amount", "arr_amount", "started_at",
        "cancelled_at", "ended_at",
        labelled("subscription_status", fv.HEALTH_LABELS, "Other").alias("health_status"),
        F.when(is_active, tier).otherwise(fv.VALUE_TIER_NONE).alias("value_tier"),
        labelled("billing_interval", fv.BILLING_LABELS, "Other").alias("billing_type"),
        "_loaded_at",
    )


def _segment(is_active: Column, active: Column, cancelled: Column, revenue: Column) -> Column:
    # Stages from last to first; a NULL flag is not "inactive".
    paying = banded(
        revenue,
        fv.SEGMENT_BY_REVENUE,
        F.when(revenue > 0, F.lit("Starter")).otherwise("Free"),
    )
    without = F.when(cancelled > 0, F.lit("Churned")).otherwise("No Subscription")
    serving = F.when(active > 0, paying).otherwise(without)
    return F.when(~is_active, F.lit("Inactive")).otherwise(serving)


def account_overview(
    accounts: DataFrame, metrics: DataFrame, as_of: datetime | Column | None = None
) -> DataFrame:
    """One row per current account with its metrics, segment, adoption and engagement.

    `metrics` comes from `billing.account_metrics`. An account whose facts point to
    several account versions has several metric rows and so several report rows; check
    `duplicated(metrics, ["account_id"])` before publishing.
    """
    now = moment(as_of)
    named = {
        "total_subscriptions": ("total_subscriptions", 0),
        "active_subscriptions": ("active_subscriptions", 0),
        "cancelled_subscriptions": ("cancelled_subscriptions", 0),
        "trialing_subscriptions": ("trialing_subscriptions", 0),
        "total_active_mrr": ("total_mrr", 0),
        "total_active_arr": ("total_arr", 0),
        "unique_plans": ("unique_plans_subscribed", 0),
        "unique_currencies": ("currencies_used", 1),
    }
    known = metrics.select("account_id", "first_subscription_at", "latest_subscription_at", *named)
    held = current_versions(accounts).select(
        "account_id", *OVERVIEW_ATTRIBUTES, "is_active", "created_at", "updated_at"
    )
    filled = held.join(known, "account_id", "left").select(
        "*",
        *[F.coalesce(F.col(c), F.lit(d)).alias(f"_{name}") for c, (name, d) in named.items()],
    )
    active, revenue = F.col("_active_subscriptions"), F.col("_total_mrr")
    since_first = whole_units_between("DAY", "first_subscription_at", now)
    since_latest = whole_units_between("DAY", "latest_subscription_at", now)
    engagement = F.when(since_first <= fv.ENGAGEMENT_NEW_DAYS, F.lit("New")).otherwise(
        capped(since_latest, fv.ENGAGEMENT_BY_DAYS, fv.ENGAGEMENT_OLD)
    )
    output = ["total_subscriptions", "active_subscriptions", "cancelled_subscriptions",
              "trialing_subscriptions", "total_mrr", "total_arr"]
    return filled.select(
        "account_id",
        *OVERVIEW_ATTRIBUTES,
        F.col("is_active").alias("account_active"),
        F.col("created_at").alias("account_created_at"),
        F.col("updated_at").alias("account_updated_at"),
        *[F.col(f"_{name}").alias(name) for name in output],
        "first_subscription_at",
        "latest_subscription_at",
        F.col("_unique_plans_subscribed").alias("unique_plans_subscribed"),
        F.col("_currencies_used").alias("currencies_used"),
        _segment(
            F.col("is_active"), active, F.col("_cancelled_subscriptions"), revenue
        ).alias("account_health_segment"),
        banded(active, fv.ADOPTION_BY_PRODUCTS, fv.ADOPTION_NONE).alias("product_adoption"),
        whole_units_between("DAY", "created_at", now).alias("account_age_days"),
        F.when(revenue != 0, engagement).alias("engagement_status"),
    )
