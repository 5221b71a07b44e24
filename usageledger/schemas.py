"""Declared shapes of the source records."""

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _declare(columns: str) -> T.StructType:
    """Flat columns from `name type` pairs; unlike the DDL parser it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


USAGE_EVENT = _declare(
    "event_id string, account_id string, user_id string, event_type string, "
    "feature_name string, session_id string, event_timestamp bigint, metadata string"
)

# Fields a message must carry to count as decoded.
USAGE_EVENT_REQUIRED = ["event_id", "account_id", "user_id", "event_type", "event_timestamp"]

RAW_USAGE_EVENTS = _declare(
    "event_id string, account_id string, user_id string, event_type string, "
    "feature_name string, session_id string, event_timestamp bigint, metadata string, "
    "_kafka_offset int, _kafka_partition int, _loaded_at timestamp"
)

RAW_SUBSCRIPTIONS = _declare(
    "id string, customer string, plan_id string, status string, billing_interval string, "
    "currency string, amount int, created bigint, canceled_at bigint, ended_at bigint, "
    "trial_start bigint, trial_end bigint, _source_system string, _loaded_at timestamp, "
    "_pipeline_run_date date"
)

ACCOUNTS = _declare(
    "account_id string, account_name string, industry string, company_size_band string, "
    "region string, account_tier string, csm_user_id string, is_active boolean, "
    "created_at timestamp, updated_at timestamp, _source_system string, _loaded_at timestamp"
)

USERS = _declare(
    "user_id string, account_id string, email string, first_name string, last_name string, "
    "role string, is_active boolean, created_at timestamp, updated_at timestamp"
)

INVOICES = _declare(
    "invoice_id string, account_id string, subscription_id string, status string, "
    "currency string, total_cents int, due_date date, paid_at timestamp, "
    "created_at timestamp, _source_system string, _loaded_at timestamp"
)

INVOICE_LINE_ITEMS = _declare(
    "line_item_id string, invoice_id string, description string, quantity int, "
    "unit_price_cents int, total_cents int, period_start date, period_end date, "
    "_source_system string, _loaded_at timestamp"
)

RUN_RESULTS = (
    "metadata struct<invocation_id: string, dbt_version: string>, "
    "results array<struct<unique_id: string, status: string, execution_time: double, "
    "adapter_response: struct<rows_affected: bigint>, message: string>>"
)

EVENT_METADATA = "browser string, os string, rows int"

SOURCE_TABLES = {
    "accounts": ACCOUNTS,
    "users": USERS,
    "subscriptions": RAW_SUBSCRIPTIONS,
    "usage_events": RAW_USAGE_EVENTS,
    "invoices": INVOICES,
    "invoice_line_items": INVOICE_LINE_ITEMS,
}
