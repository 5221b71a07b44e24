"""Labels, lists and limits that results must agree on."""

from decimal import Decimal

# Subscription states.
KNOWN_STATUSES = [
    "active", "cancelled", "trialing", "past_due", "incomplete", "unpaid", "incomplete_expired",
]
AT_RISK_STATUSES = ["past_due", "incomplete", "unpaid"]
BILLING_INTERVALS = ["month", "year", "week", "day"]

# Report labels.
HEALTH_LABELS = {
    "active": "Active",
    "cancelled": "Cancelled",
    "trialing": "Trialing",
    "past_due": "At Risk",
    "incomplete": "At Risk",
    "unpaid": "At Risk",
}
BILLING_LABELS = {"year": "Annual", "month": "Monthly"}
VALUE_TIERS = [(500, "High Value"), (100, "Medium Value")]
VALUE_TIER_FLOOR = "Low Value"
VALUE_TIER_NONE = "Non-Revenue"
SEGMENT_BY_REVENUE = [(1000, "Enterprise"), (500, "Growth")]
ACCOUNT_SEGMENTS = [
    "Inactive", "Churned", "No Subscription", "Enterprise", "Growth", "Starter", "Free",
]
ADOPTION_BY_PRODUCTS = [(3, "Multi-Product"), (2, "Dual-Product"), (1, "Single-Product")]
ADOPTION_NONE = "No Active Products"
ENGAGEMENT_NEW_DAYS = 30
ENGAGEMENT_BY_DAYS = [(90, "Active"), (180, "Engaged")]
ENGAGEMENT_OLD = "Dormant"

# Key formats.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
VERSION_SEPARATOR = "|"

# Source labels and check limits.
BATCH_SOURCE = "spark_batch"
BACKFILL_SOURCE = "spark_historical_backfill"
MONTHS_PER_YEAR = 12
MRR_RANGE = (Decimal(0), Decimal(999999))
CURRENCY_LENGTH = 3
VOLUME_LOOKBACK_DAYS = 8
VOLUME_LIMIT = 0.30
RECONCILIATION_LIMIT = 0.0001
FRESHNESS_LIMIT_HOURS = 6
RAW_RETENTION_DAYS = 90
LAG_LIMITS = (1000, 10000)
LAKE_AGE_MINUTES = (15, 60)
STAGING_AGE_MINUTES = (60, 240)
LOOKBACK_DAYS = 3
FLUSH_SECONDS = 30
