"""The SQL each registered query is compared with, over the same whole tables."""

from __future__ import annotations

# Source tables -------------------------------------------------------------------

EVENTS = """usage_events AS (
  SELECT 'evt_' || event_id AS event_id,
         CASE WHEN event_id % 97 <> 0 THEN 'acc_' || (user_id % 50) END AS account_id,
         'usr_' || user_id AS user_id,
         CASE WHEN older = 1 THEN 'stale'
              WHEN event_id % 3 = 0 THEN ' ' || upper(event_type) || ' '
              ELSE event_type END AS event_type,
         CASE WHEN event_id % 11 <> 0 THEN ' F' || (event_id % 7) END AS feature_name,
         's_' || user_id || '_' || CAST(ts AS DATE) AS session_id,
         epoch_us(ts) // 1000 AS event_timestamp,
         props AS metadata,
         CAST(event_id * 2 + 1 - older AS INTEGER) AS _kafka_offset,
         CAST(user_id % 6 AS INTEGER) AS _kafka_partition,
         ts + to_days(CAST(1 - older AS INTEGER)) AS _loaded_at
  FROM (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS older FROM events)
)"""

LATEST_EVENTS = EVENTS + """, latest_events AS (
  SELECT * FROM usage_events
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _loaded_at DESC) = 1
), clean_events AS (
  SELECT * REPLACE (lower(trim(event_type)) AS event_type, lower(trim(feature_name)) AS feature_name),
         CAST(make_timestamp(event_timestamp * 1000) AS DATE) AS event_date
  FROM latest_events WHERE account_id IS NOT NULL
)"""

METRICS = """count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT session_id) AS unique_sessions, min(event_timestamp) AS first_event_ts,
  max(event_timestamp) AS last_event_ts"""
GRAIN = "event_date, account_id, event_type, feature_name"

SUBSCRIPTIONS = """raw_subscriptions AS (
  SELECT 'sub_' || o_orderkey AS id,
         CASE WHEN o_custkey % 7 = 0 THEN 'acc_x' ELSE 'acc_' END || o_custkey AS customer,
         o_orderpriority AS plan_id,
         CASE WHEN older = 1 THEN 'trialing' WHEN o_orderkey % 250 = 9 THEN 'paused'
              ELSE ['ACTIVE ', 'active', 'incomplete', ' Unpaid', 'Active', ' Cancelled', 'trialing', 'past_due'][o_orderkey % 8 + 1]
         END AS status,
         CASE o_orderkey % 4 WHEN 0 THEN 'year' WHEN 3 THEN 'week' ELSE 'month' END AS billing_interval,
         CASE WHEN o_orderkey % 5 = 0 THEN ' eur' WHEN o_orderkey % 333 = 1 THEN 'us' ELSE 'USD' END AS currency,
         CASE WHEN o_orderkey % 500 = 3 THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS amount,
         o_orderdate AS started,
         CASE WHEN o_orderkey % 8 = 5 THEN o_orderdate + INTERVAL 30 DAY END AS ended,
         CASE WHEN o_orderkey % 8 = 6 THEN o_orderdate END AS trial,
         o_orderdate + to_days(CAST(1 - older AS INTEGER)) AS _loaded_at
  FROM (SELECT *, unnest(CASE WHEN o_orderkey % 25 = 0 THEN [0, 1] ELSE [0] END) AS older FROM orders)
)"""

STAGED = SUBSCRIPTIONS + """, staged AS (
  SELECT id AS subscription_id, customer AS account_id, plan_id,
         lower(trim(status)) AS subscription_status, lower(trim(billing_interval)) AS billing_interval,
         upper(trim(currency)) AS currency,
         CAST(try_cast(amount AS BIGINT) / 100.0 AS DECIMAL(18,6)) AS mrr_amount,
         started AS started_at, ended AS cancelled_at, ended AS ended_at,
         trial AS trial_start_at, trial + INTERVAL 30 DAY AS trial_end_at,
         'stripe' AS _source_system, _loaded_at, CAST(_loaded_at AS DATE) AS _pipeline_run_date
  FROM raw_subscriptions
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY _loaded_at DESC) = 1
)"""


def _account_states(name: str, source: str, version: str) -> str:
    return f"""{name} AS (
  SELECT 'acc_' || c_custkey AS account_id, c_name AS account_name, c_mktsegment AS industry,
         CASE WHEN c_acctbal < 0 THEN 'SMB' WHEN c_acctbal < 5000 THEN 'Mid-Market' ELSE 'Enterprise' END AS company_size_band,
         r_name AS region,
         ['Free', 'Growth', 'Enterprise'][
           (CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 1 ELSE 2 END + {version}) % 3 + 1] AS account_tier,
         'csm_' || (c_nationkey % 7) AS csm_user_id,
         CASE WHEN c_custkey % 50 <> 7 THEN c_acctbal >= -500 END AS is_active,
         TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
         TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 365 + 30 * {version} AS INTEGER)) AS updated_at
  FROM {source} JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


SCD_ID = "md5(account_id || '|' || CAST(updated_at AS VARCHAR))"
ACCOUNTS = _account_states("accounts", "customer", "0") + f""", account_keys AS (
  SELECT *, {SCD_ID} AS account_sk FROM accounts
)"""
CHANGED = _account_states("changed", "customer", "(c_custkey % 3)")
ACCOUNT_LOG = _account_states(
    "account_log",
    "(SELECT *, unnest(range(0, c_custkey % 3 + 1)) AS v FROM customer)",
    "v",
)
HISTORY = ACCOUNT_LOG + f""", history AS (
  SELECT account_id, account_tier, {SCD_ID} AS dbt_scd_id, updated_at AS dbt_updated_at,
         updated_at AS dbt_valid_from,
         lead(updated_at) OVER (PARTITION BY account_id ORDER BY updated_at) AS dbt_valid_to
  FROM account_log
)"""

FACTS = STAGED + ", " + ACCOUNTS + """, facts AS (
  SELECT md5(subscription_id) AS subscription_sk, staged.*, account_sk,
         CAST(mrr_amount * 12 AS DECIMAL(18,6)) AS arr_amount
  FROM staged LEFT JOIN account_keys USING (account_id)
)"""

PER_ACCOUNT = FACTS + """, per_account AS (
  SELECT account_id, account_sk, count(*) AS total_subscriptions,
         count(*) FILTER (subscription_status = 'active') AS active_subscriptions,
         count(*) FILTER (subscription_status = 'cancelled') AS cancelled_subscriptions,
         count(*) FILTER (subscription_status = 'trialing') AS trialing_subscriptions,
         CAST(sum(CASE WHEN subscription_status = 'active' THEN mrr_amount ELSE 0 END) AS DOUBLE) AS total_active_mrr,
         CAST(sum(CASE WHEN subscription_status = 'active' THEN arr_amount ELSE 0 END) AS DOUBLE) AS total_active_arr,
         min(started_at) AS first_subscription_at, max(started_at) AS latest_subscription_at,
         count(DISTINCT plan_id) AS unique_plans, count(DISTINCT currency) AS unique_currencies
  FROM facts GROUP BY ALL
)"""

MONTHLY = FACTS + """, monthly AS (
  SELECT CAST(date_trunc('month', started_at) AS DATE) AS snapshot_month, subscription_id, facts.account_id,
         account_name, industry, company_size_band, region, account_tier, plan_id, subscription_status,
         billing_interval, currency, CAST(mrr_amount AS DOUBLE) AS mrr_amount, CAST(arr_amount AS DOUBLE) AS arr_amount,
         started_at, cancelled_at, ended_at,
         CASE subscription_status WHEN 'active' THEN 'Active' WHEN 'cancelled' THEN 'Cancelled'
              WHEN 'trialing' THEN 'Trialing' WHEN 'past_due' THEN 'At Risk' WHEN 'incomplete' THEN 'At Risk'
              WHEN 'unpaid' THEN 'At Risk' ELSE 'Other' END AS health_status,
         CASE WHEN subscription_status <> 'active' THEN 'Non-Revenue' WHEN mrr_amount >= 500 THEN 'High Value'
              WHEN mrr_amount >= 100 THEN 'Medium Value' ELSE 'Low Value' END AS value_tier,
         CASE billing_interval WHEN 'year' THEN 'Annual' WHEN 'month' THEN 'Monthly' ELSE 'Other' END AS billing_type,
         _loaded_at
  FROM facts LEFT JOIN accounts ON accounts.account_id = facts.account_id
)"""

OVERVIEW = PER_ACCOUNT + """, joined AS (
  SELECT a.*, coalesce(total_subscriptions, 0) AS n_all, coalesce(active_subscriptions, 0) AS n_active,
         coalesce(cancelled_subscriptions, 0) AS n_cancelled, coalesce(trialing_subscriptions, 0) AS n_trial,
         coalesce(total_active_mrr, 0) AS mrr, coalesce(total_active_arr, 0) AS arr,
         first_subscription_at, latest_subscription_at,
         coalesce(unique_plans, 0) AS n_plans, coalesce(unique_currencies, 1) AS n_currencies,
         date_sub('day', first_subscription_at, TIMESTAMP '2001-08-15') AS first_age,
         date_sub('day', latest_subscription_at, TIMESTAMP '2001-08-15') AS latest_age
  FROM accounts a LEFT JOIN per_account p ON a.account_id = p.account_id
), overview AS (
  SELECT account_id, account_name, industry, company_size_band, region, account_tier, csm_user_id,
         is_active AS account_active, created_at AS account_created_at, updated_at AS account_updated_at,
         n_all AS total_subscriptions, n_active AS active_subscriptions, n_cancelled AS cancelled_subscriptions,
         n_trial AS trialing_subscriptions, mrr AS total_mrr, arr AS total_arr,
         first_subscription_at, latest_subscription_at,
         n_plans AS unique_plans_subscribed, n_currencies AS currencies_used,
         CASE WHEN NOT is_active THEN 'Inactive'
              WHEN n_active = 0 THEN CASE WHEN n_cancelled > 0 THEN 'Churned' ELSE 'No Subscription' END
              WHEN mrr >= 1000 THEN 'Enterprise' WHEN mrr >= 500 THEN 'Growth' WHEN mrr > 0 THEN 'Starter'
              ELSE 'Free' END AS account_health_segment,
         CASE WHEN n_active >= 3 THEN 'Multi-Product' WHEN n_active = 2 THEN 'Dual-Product'
              WHEN n_active = 1 THEN 'Single-Product' ELSE 'No Active Products' END AS product_adoption,
         date_sub('day', created_at, TIMESTAMP '2001-08-15') AS account_age_days,
         CASE WHEN mrr = 0 THEN NULL WHEN first_age <= 30 THEN 'New' WHEN latest_age <= 90 THEN 'Active'
              WHEN latest_age <= 180 THEN 'Engaged' ELSE 'Dormant' END AS engagement_status
  FROM joined
)"""

MERGE = FACTS + """, loaded AS (
  SELECT subscription_id, subscription_status, CAST(mrr_amount AS DOUBLE) AS mrr_amount, started_at
  FROM facts WHERE _loaded_at <= TIMESTAMP '2000-01-01'
), updates AS (
  SELECT subscription_id, subscription_status, CAST(mrr_amount + 1 AS DOUBLE) AS mrr_amount,
         CASE WHEN subscription_status = 'cancelled' THEN started_at - INTERVAL 365 DAY ELSE started_at END AS started_at
  FROM facts WHERE started_at >= TIMESTAMP '1999-01-01'
), merged AS (
  SELECT * FROM updates
  UNION ALL SELECT * FROM loaded WHERE subscription_id NOT IN (SELECT subscription_id FROM updates)
)"""

INVOICES = """invoices AS (
  SELECT 'inv_' || o_orderkey AS invoice_id, CAST(floor(o_totalprice) AS BIGINT) AS total_cents FROM orders
), line_items AS (
  SELECT 'inv_' || CASE WHEN l_orderkey % 101 = 0 THEN l_orderkey + 10000000 ELSE l_orderkey END AS invoice_id,
         l_linenumber AS line_number
  FROM lineitem
)"""

PAYLOAD = """SELECT 'sub_' || o_orderkey AS id, 'acc_' || c_custkey AS customer_id,
  c_mktsegment AS customer_address_segment, o_orderpriority AS plan_id, o_orderstatus AS status,
  CAST(floor(o_totalprice) AS BIGINT) AS amount,
  '[{"code":"' || o_orderstatus || '","quantity":1}]' AS items,
  'stripe' AS _source_system, DATE '2024-11-01' AS _pipeline_run_date
  FROM orders JOIN customer ON o_custkey = c_custkey"""

MESSAGES = EVENTS + """, messages AS (
  SELECT *, _kafka_offset // 2 % 50 = 0 AS truncated, truncated OR account_id IS NULL AS broken FROM usage_events
)"""


def _declared(model: str, source: str, rules: list[tuple[str, str]], keys: list[tuple[str, str]]) -> list[str]:
    """Failure counts per rule; `keys` are (check name, key list), single keys skip NULL."""
    parts = [
        f"SELECT '{model}' AS model, '{name}' AS check_name, count(*) FILTER ({broken}) AS failures FROM {source}"
        for name, broken in rules
    ]
    for name, key in keys:
        keep = "TRUE" if "," in key else f"{key} IS NOT NULL"
        parts.append(
            f"SELECT '{model}', '{name}', count(*) FROM (SELECT {key} FROM {source} WHERE {keep} "
            f"GROUP BY {key} HAVING count(*) > 1)"
        )
    return parts


def _nulls(*columns: str) -> list[tuple[str, str]]:
    return [(f"not_null_{c}", f"{c} IS NULL") for c in columns]


def _values(column: str, *known: str) -> tuple[str, str]:
    listed = ", ".join(f"'{v}'" for v in known)
    return (f"accepted_values_{column}", f"{column} NOT IN ({listed})")


def _declared_tests() -> str:
    statuses = _values("subscription_status", "active", "cancelled", "trialing", "past_due",
                       "incomplete", "unpaid", "incomplete_expired")
    intervals = _values("billing_interval", "month", "year", "week", "day")
    currency = ("length_currency", "length(currency) <> 3")
    core = _nulls("subscription_id", "account_id", "plan_id", "subscription_status", "currency",
                  "mrr_amount", "started_at")
    loaded = _nulls("_source_system", "_loaded_at")
    parts = [
        *_declared("raw_accounts", "accounts", _nulls("account_id"), [("unique_account_id", "account_id")]),
        *_declared("raw_subscriptions", "raw_subscriptions", _nulls("id"), []),
        *_declared("stg_subscriptions", "staged", [*core, *loaded, statuses, intervals, currency],
                   [("unique_subscription_id", "subscription_id")]),
        *_declared("snap_accounts", "account_keys",
                   [("not_null_account_id", "account_id IS NULL"), ("not_null_dbt_scd_id", "account_sk IS NULL")],
                   [("unique_dbt_scd_id", "account_sk")]),
        *_declared("int_account_metrics", "per_account",
                   _nulls("account_id", "account_sk", "total_subscriptions"),
                   [("unique_account_id", "account_id")]),
        *_declared("int_plan_metrics", "(SELECT plan_id, count(*) AS total_subscriptions FROM facts GROUP BY 1)",
                   _nulls("plan_id", "total_subscriptions"), [("unique_plan_id", "plan_id")]),
        *_declared("fct_subscriptions", "facts",
                   [*core, *loaded, *_nulls("subscription_sk", "account_sk"), statuses, intervals, currency,
                    ("range_mrr_amount", "mrr_amount < 0 OR mrr_amount > 999999"),
                    ("active_with_negative_mrr", "subscription_status = 'active' AND mrr_amount < 0")],
                   [("unique_subscription_sk", "subscription_sk"), ("unique_subscription_id", "subscription_id")]),
        *_declared("rpt_subscription_monthly", "monthly",
                   [*core, *_nulls("snapshot_month"), statuses, currency,
                    _values("health_status", "Active", "Cancelled", "Trialing", "At Risk", "Other"),
                    _values("value_tier", "High Value", "Medium Value", "Low Value", "Non-Revenue"),
                    _values("billing_type", "Annual", "Monthly", "Other")],
                   [("unique_together_snapshot_month_subscription_id", "snapshot_month, subscription_id")]),
        *_declared("rpt_account_overview", "overview",
                   [*_nulls("account_id", "total_subscriptions", "active_subscriptions", "cancelled_subscriptions",
                            "trialing_subscriptions", "total_mrr", "total_arr", "unique_plans_subscribed",
                            "currencies_used", "account_health_segment", "product_adoption", "account_age_days"),
                    _values("account_health_segment", "Inactive", "Churned", "No Subscription", "Enterprise",
                            "Growth", "Starter", "Free"),
                    _values("product_adoption", "Multi-Product", "Dual-Product", "Single-Product",
                            "No Active Products"),
                    _values("engagement_status", "New", "Active", "Engaged", "Dormant")],
                   [("unique_account_id", "account_id")]),
    ]
    monthly = MONTHLY[len(FACTS):]
    overview = OVERVIEW[len(FACTS):]
    return (
        f"WITH {FACTS}{monthly}{overview} SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ("
        + " UNION ALL ".join(parts) + ")"
    )


def _judged(value: str, limit: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN 'no_data' WHEN {value} > {limit} THEN 'fail' ELSE 'pass' END AS status"


def _volume(source: str, ds: str) -> str:
    return f"""SELECT today, prior_mean, abs(today - prior_mean) / prior_mean AS deviation FROM (
  SELECT max(n) FILTER (d = DATE '{ds}') AS today, avg(n) FILTER (d < DATE '{ds}') AS prior_mean
  FROM (SELECT CAST(_loaded_at AS DATE) AS d, count(*) AS n FROM {source}
        WHERE CAST(_loaded_at AS DATE) >= DATE '{ds}' - 8 GROUP BY 1))"""


def _mrr(where: str) -> str:
    return f"""SELECT staging_mrr, transform_mrr, abs(transform_mrr - staging_mrr) / staging_mrr AS diff FROM (
  SELECT (SELECT CAST(sum(mrr_amount) AS DOUBLE) FROM staged WHERE subscription_status = 'active' AND {where}) AS staging_mrr,
         (SELECT CAST(sum(mrr_amount) AS DOUBLE) FROM facts WHERE subscription_status = 'active' AND {where}) AS transform_mrr)"""


MONEY_OUT = "CAST(mrr_amount AS DOUBLE) AS mrr_amount"
BACKFILL_END = "DATE '2024-01-31'"


def _backfill(days: int) -> str:
    return f"""WITH {EVENTS}, ranged AS (
  SELECT *, DATE '2024-01-01' + CAST((CAST(_loaded_at AS DATE) - DATE '2024-01-01') // {days} * {days} AS INTEGER) AS opens
  FROM usage_events WHERE CAST(_loaded_at AS DATE) BETWEEN DATE '2024-01-01' AND {BACKFILL_END}
), latest AS (
  SELECT * FROM ranged QUALIFY row_number() OVER (PARTITION BY opens, event_id ORDER BY _loaded_at DESC) = 1
), clean AS (
  SELECT * REPLACE (lower(trim(event_type)) AS event_type, lower(trim(feature_name)) AS feature_name),
         CAST(make_timestamp(event_timestamp * 1000) AS DATE) AS event_date
  FROM latest WHERE account_id IS NOT NULL
)
SELECT {GRAIN}, {METRICS}, 'spark_historical_backfill' AS _source, CAST(opens AS VARCHAR) AS _batch_start,
       CAST(least(opens + {days - 1}, {BACKFILL_END}) AS VARCHAR) AS _batch_end
FROM clean GROUP BY {GRAIN}, opens"""


DAILY = f"WITH {LATEST_EVENTS} SELECT {GRAIN}, {METRICS}, 'spark_batch' AS _source FROM clean_events GROUP BY {GRAIN}"
EXPIRED = f"""WITH {EVENTS} SELECT CAST(_loaded_at AS DATE) AS load_date, count(*) AS row_count FROM usage_events
  WHERE CAST(_loaded_at AS DATE) >= DATE '2024-01-21' GROUP BY 1"""
MERGED = f"""WITH {MERGE} SELECT *, CAST(date_trunc('month', started_at) AS DATE) AS started_month FROM merged"""
CHANGED_FACTS = f"""WITH {FACTS}, {CHANGED} SELECT subscription_id, account_id, subscription_status, started_at,
  CASE WHEN changed.account_id IS NOT NULL
       THEN md5(account_id || '|' || CAST(changed.updated_at AS VARCHAR)) END AS account_sk
  FROM staged LEFT JOIN changed USING (account_id)"""
APPLIED = f"""WITH {ACCOUNTS}, {CHANGED}, held AS (
  SELECT * FROM accounts WHERE industry <> 'BUILDING'
), seen AS (
  SELECT * FROM changed WHERE company_size_band <> 'SMB'
), kept AS (
  SELECT held.account_id, held.account_tier, held.updated_at,
         CASE WHEN seen.account_id IS NULL THEN TIMESTAMP '2001-08-15'
              WHEN seen.updated_at > held.updated_at THEN seen.updated_at END AS dbt_valid_to
  FROM held LEFT JOIN seen USING (account_id)
), opened AS (
  SELECT account_id, account_tier, updated_at, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM seen
  WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.account_id = seen.account_id AND held.updated_at >= seen.updated_at)
)
SELECT account_id, account_tier, {SCD_ID} AS dbt_scd_id, updated_at AS dbt_updated_at, updated_at AS dbt_valid_from, dbt_valid_to
FROM (SELECT * FROM kept UNION ALL SELECT * FROM opened)"""
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# The nodes of the run documents.
NODES = """'model.shop.' || node_name AS node_id, node_name, CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'error' END AS status,
  execution_time_s, rows_affected, message, 'run_' || o_orderkey AS invocation_id, '1.8.0' AS dbt_version
  FROM (SELECT o_orderkey, o_orderstatus, 'stg_' || o_orderkey AS node_name, o_orderkey AS rows_affected, o_orderpriority AS message,
               round(CAST(o_totalprice AS DOUBLE), 2) AS execution_time_s FROM orders
        UNION ALL SELECT o_orderkey, o_orderstatus, 'fct_' || o_orderkey, 0, '', 1.5 FROM orders)"""

LANDED = f"""WITH {MESSAGES} SELECT * EXCLUDE (truncated, broken, _loaded_at)
  REPLACE (CAST(_kafka_offset AS BIGINT) AS _kafka_offset), epoch_us(_loaded_at) // 1000 AS _kafka_timestamp
  FROM messages WHERE NOT broken"""

SQL: dict[str, str] = {
    "usage_daily": DAILY,
    "usage_daily_table": DAILY,
    "usage_daily_one_load_day": f"""WITH {EVENTS}, latest AS (
  SELECT * FROM usage_events WHERE CAST(_loaded_at AS DATE) = DATE '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _loaded_at DESC) = 1
), clean AS (
  SELECT * REPLACE (lower(trim(event_type)) AS event_type, lower(trim(feature_name)) AS feature_name),
         CAST(make_timestamp(event_timestamp * 1000) AS DATE) AS event_date
  FROM latest WHERE account_id IS NOT NULL
) SELECT {GRAIN}, {METRICS}, 'spark_batch' AS _source FROM clean GROUP BY {GRAIN}""",
    "usage_dedup_latest": f"WITH {LATEST_EVENTS} SELECT * FROM latest_events",
    "usage_clean": f"WITH {LATEST_EVENTS} SELECT * FROM clean_events",
    "usage_backfill_1d": _backfill(1),
    "usage_backfill_7d": _backfill(7),
    "usage_backfill_table": _backfill(7),
    "usage_daily_two_loads": f"""WITH {EVENTS.replace("usage_events AS", "source_events AS")}, usage_events AS (
    SELECT * FROM source_events WHERE CAST(_loaded_at AS DATE) <= DATE '2024-01-15'
    UNION ALL SELECT * REPLACE (event_timestamp - 3456000000 AS event_timestamp, _loaded_at + INTERVAL 1 DAY AS _loaded_at)
    FROM source_events WHERE CAST(_loaded_at AS DATE) = DATE '2024-01-15'
  ){LATEST_EVENTS[len(EVENTS):]} SELECT {GRAIN}, {METRICS}, 'spark_batch' AS _source
  FROM clean_events WHERE event_date IN (
    SELECT CAST(make_timestamp(event_timestamp * 1000) AS DATE) FROM usage_events WHERE event_id IN (
      SELECT event_id FROM usage_events WHERE CAST(_loaded_at AS DATE) >= DATE '2024-01-15'))
  GROUP BY {GRAIN}""",
    "usage_daily_then_backfill": f"""WITH {LATEST_EVENTS} SELECT {GRAIN}, {METRICS}, 'spark_historical_backfill' AS _source
  FROM clean_events WHERE event_date IN (
    SELECT CAST(make_timestamp(event_timestamp * 1000) AS DATE) FROM usage_events WHERE event_id IN (
      SELECT event_id FROM usage_events WHERE CAST(_loaded_at AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-18'))
  GROUP BY {GRAIN}""",
    "usage_null_times": f"""WITH {EVENTS.replace("usage_events AS", "source_events AS")}, usage_events AS (
    SELECT * REPLACE (CASE WHEN _kafka_offset // 2 % 3 <> 1 THEN event_timestamp END AS event_timestamp)
    FROM source_events WHERE CAST(_loaded_at AS DATE) <= DATE '2024-01-16'
  ){LATEST_EVENTS[len(EVENTS):]}, touched AS (
    SELECT DISTINCT CAST(make_timestamp(event_timestamp * 1000) AS DATE) AS day FROM usage_events WHERE event_id IN (
      SELECT event_id FROM usage_events WHERE CAST(_loaded_at AS DATE) >= DATE '2024-01-15'))
  SELECT {GRAIN}, {METRICS}, 'spark_batch' AS _source
  FROM clean_events WHERE EXISTS (SELECT 1 FROM touched WHERE day IS NOT DISTINCT FROM event_date) GROUP BY {GRAIN}""",
    "usage_incremental_loads": f"""WITH {EVENTS.replace("usage_events AS", "source_events AS")}, numbered AS (
    SELECT *, _kafka_offset // 2 AS n FROM source_events
  ), usage_events AS (
    SELECT * EXCLUDE (n) REPLACE (
      CASE WHEN n % 50 <> 7 THEN event_timestamp END AS event_timestamp,
      TIMESTAMP '2024-03-01' + to_days(CAST(CASE WHEN event_type = 'stale' THEN n // 20 ELSE n END % 5 AS INTEGER)) AS _loaded_at)
    FROM numbered
    UNION ALL SELECT * EXCLUDE (n) REPLACE (
      CASE WHEN n % 50 <> 7 THEN event_timestamp - 3456000000 END AS event_timestamp,
      _kafka_offset + 1000000000 AS _kafka_offset, TIMESTAMP '2024-03-05' AS _loaded_at)
    FROM numbered WHERE n % 40 = 0 AND event_type <> 'stale'
  ){LATEST_EVENTS[len(EVENTS):].replace("_loaded_at DESC", "_loaded_at DESC, _kafka_partition DESC, _kafka_offset DESC")}
  SELECT {GRAIN}, {METRICS}, 'spark_batch' AS _source FROM clean_events GROUP BY {GRAIN}""",
    "usage_dry_run": f"SELECT count(*) AS row_count, CAST(least(5, count(*)) AS INTEGER) AS shown FROM ({_backfill(1)})",
    "usage_appended_batches": f"SELECT * FROM ({_backfill(7)}) UNION ALL SELECT * FROM ({_backfill(7)})",
    "usage_view": f"""WITH {EVENTS} SELECT account_id, count(*) AS event_count, max(event_timestamp) AS last_event_ts
  FROM usage_events GROUP BY 1""",
    "facts_after_account_changes": CHANGED_FACTS,
    "facts_full_refresh": CHANGED_FACTS,
    "lookup_hot_key": """SELECT o_orderkey, key AS c_custkey, c_name FROM (
    SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS BIGINT) AS key FROM orders)
  LEFT JOIN customer ON key = c_custkey""",
    "merge_resumed": MERGED,
    "merge_file_level": MERGED,
    "merge_stopped_midway": CHANGED_FACTS,
    "snapshot_resumed": APPLIED,
    "ingest_type_drift": """SELECT 'sub_' || o_orderkey AS id, CASE o_orderkey % 3
    WHEN 1 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
    WHEN 2 THEN 'about ' || CAST(floor(o_totalprice) AS BIGINT) END AS amount FROM orders JOIN customer ON o_custkey = c_custkey""",
    "gate_stops": f"""WITH {EVENTS}, missing AS (
    SELECT unnest(['event_id', 'account_id', 'event_type']) AS check_name,
           unnest([count_if(event_id IS NULL), count_if(account_id IS NULL), count_if(event_type IS NULL)]) AS failures
    FROM usage_events)
  SELECT check_name, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status, failures > 0 AS named FROM missing""",
    "schema_drift_columns": """SELECT column_name, change, count(*) AS row_count FROM customer,
  (VALUES ('c_email', 'missing'), ('c_name', 'added')) AS t(column_name, change) GROUP BY 1, 2""",
    "usage_recompute_days": f"""WITH {LATEST_EVENTS} SELECT {GRAIN}, {METRICS}, 'spark_batch' AS _source
  FROM clean_events WHERE event_date IN (
    SELECT CAST(make_timestamp(event_timestamp * 1000) AS DATE) FROM usage_events WHERE event_id IN (
      SELECT event_id FROM usage_events WHERE CAST(_loaded_at AS DATE) = DATE '2024-01-15'))
  GROUP BY {GRAIN}""",
    "usage_recent_days": f"""WITH {LATEST_EVENTS} SELECT {GRAIN}, {METRICS}, 'spark_batch' AS _source
  FROM clean_events WHERE event_date >= DATE '2024-01-27' GROUP BY {GRAIN}""",
    "usage_event_type_mix": f"""WITH {LATEST_EVENTS} SELECT event_type, count(*) AS event_count,
  count(DISTINCT account_id) AS unique_accounts FROM clean_events GROUP BY 1""",
    "usage_metadata_json": f"""WITH {EVENTS} SELECT CAST(json_extract(metadata, '$.k') AS INTEGER) AS k, count(*) AS event_count,
  count(DISTINCT event_id) AS unique_events FROM usage_events GROUP BY 1""",
    "load_range_scan": f"""WITH {EVENTS} SELECT event_id, event_type, _loaded_at FROM usage_events
  WHERE CAST(_loaded_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "event_lake_paths": f"""WITH {EVENTS} SELECT 'raw/events/' || strftime(_loaded_at, '%Y/%m/%d/%H') AS folder,
  count(*) AS record_count FROM usage_events GROUP BY 1""",
    "stg_subscriptions": f"WITH {STAGED} SELECT * REPLACE ({MONEY_OUT}) FROM staged",
    "fct_subscriptions": f"""WITH {FACTS} SELECT * EXCLUDE (_pipeline_run_date)
  REPLACE ({MONEY_OUT}, CAST(arr_amount AS DOUBLE) AS arr_amount) FROM facts""",
    "account_metrics": f"WITH {PER_ACCOUNT} SELECT * FROM per_account",
    "plan_metrics": f"""WITH {FACTS} SELECT plan_id, count(*) AS total_subscriptions,
  count(*) FILTER (subscription_status = 'active') AS active_subscriptions,
  count(*) FILTER (subscription_status = 'cancelled') AS cancelled_subscriptions,
  count(*) FILTER (subscription_status = 'trialing') AS trialing_subscriptions,
  count(*) FILTER (subscription_status IN ('past_due', 'incomplete', 'unpaid')) AS at_risk_subscriptions,
  CAST(sum(CASE WHEN subscription_status = 'active' THEN mrr_amount ELSE 0 END) AS DOUBLE) AS plan_active_mrr,
  CAST(sum(CASE WHEN subscription_status = 'active' THEN arr_amount ELSE 0 END) AS DOUBLE) AS plan_active_arr,
  round(CAST(sum(mrr_amount) FILTER (subscription_status = 'active') AS DOUBLE)
        / count(mrr_amount) FILTER (subscription_status = 'active'), 4) AS avg_active_mrr,
  count(DISTINCT account_id) AS unique_accounts, min(started_at) AS first_subscription_at,
  max(started_at) AS latest_subscription_at FROM facts GROUP BY 1""",
    "mrr_by_status": f"""WITH {FACTS} SELECT subscription_status, count(*) AS subscription_count,
  CAST(round(sum(mrr_amount), 2) AS DOUBLE) AS total_mrr FROM facts GROUP BY 1""",
    "rpt_subscription_monthly": f"WITH {MONTHLY} SELECT * FROM monthly",
    "rpt_account_overview": f"WITH {OVERVIEW} SELECT * FROM overview",
    "account_segments": f"""WITH {OVERVIEW} SELECT account_health_segment, product_adoption, engagement_status,
  count(*) AS account_count, CAST(sum(CAST(total_mrr AS DECIMAL(28,6))) AS DOUBLE) AS segment_mrr FROM overview GROUP BY 1, 2, 3""",
    "surrogate_keys": f"""WITH {EVENTS} SELECT event_id, _loaded_at, md5(event_id
  || '-' || coalesce(account_id, '_dbt_utils_surrogate_key_null_')
  || '-' || coalesce(feature_name, '_dbt_utils_surrogate_key_null_')) AS event_key FROM usage_events""",
    "text_cleanup": f"""WITH {SUBSCRIPTIONS} SELECT lower(trim(status)) AS status, upper(trim(currency)) AS currency,
  nullif(trim(billing_interval), '') AS billing_interval, split_part(plan_id, '-', -1) AS plan_name,
  count(*) AS row_count FROM raw_subscriptions GROUP BY 1, 2, 3, 4""",
    "incremental_new_rows": f"""WITH {STAGED} SELECT subscription_id, _loaded_at FROM staged WHERE _loaded_at > (
  SELECT max(_loaded_at) FROM staged WHERE _loaded_at <= TIMESTAMP '2000-01-01')""",
    "merge_upsert_rows": MERGED,
    "merge_partitioned_table": MERGED,
    "schema_evolution_append": """SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS INTEGER) AS nation_key FROM customer
  UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
    "scd2_history": f"WITH {HISTORY} SELECT * FROM history",
    "scd2_current": f"WITH {HISTORY} SELECT * FROM history WHERE dbt_valid_to IS NULL",
    "scd2_apply_deletes": APPLIED,
    "scd2_snapshot_runs": APPLIED,
    "expire_partitions": EXPIRED,
    "expire_partitioned_table": EXPIRED,
    "dq_not_null": f"WITH {EVENTS} SELECT event_id, _loaded_at FROM usage_events WHERE account_id IS NULL",
    "dq_unique": f"WITH {EVENTS} SELECT event_id, count(*) AS row_count FROM usage_events GROUP BY 1 HAVING count(*) > 1",
    "dq_accepted_values": f"""WITH {STAGED} SELECT subscription_id, subscription_status FROM staged WHERE subscription_status
  NOT IN ('active', 'cancelled', 'trialing', 'past_due', 'incomplete', 'unpaid', 'incomplete_expired')""",
    "dq_range": f"WITH {INVOICES} SELECT * FROM invoices WHERE total_cents < 10000 OR total_cents > 400000",
    "dq_length": f"WITH {STAGED} SELECT subscription_id, currency FROM staged WHERE length(currency) <> 3",
    "dq_unique_combo": f"""WITH {INVOICES} SELECT invoice_id, line_number, count(*) AS row_count FROM line_items
  GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_relationships": f"""WITH {INVOICES} SELECT invoice_id, count(*) AS row_count FROM line_items
  WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices) GROUP BY 1""",
    "dq_account_relationships": f"""WITH {STAGED}, {ACCOUNTS} SELECT account_id, count(*) AS row_count FROM staged
  WHERE account_id NOT IN (SELECT account_id FROM accounts) GROUP BY 1""",
    "dq_negative_mrr": """SELECT 'acc_' || c_custkey AS account_id, c_acctbal AS mrr_amount FROM customer
  WHERE c_custkey % 50 <> 7 AND c_acctbal >= -500 AND c_acctbal < 0""",
    "dq_volume_anomaly": f"""WITH {EVENTS} SELECT *, {_judged('deviation', '0.3')} FROM ({_volume('usage_events', '2024-01-15')})""",
    "dq_mrr_reconciliation": f"WITH {FACTS} SELECT *, {_judged('diff', '0.0001')} FROM ({_mrr('TRUE')})",
    "dq_freshness": f"""WITH {SUBSCRIPTIONS} SELECT *, {_judged('hours_old', '6')} FROM (
  SELECT max(_loaded_at) AS newest, date_sub('hour', max(_loaded_at), TIMESTAMP '2001-08-15') AS hours_old FROM raw_subscriptions)""",
    "dq_layer_age": f"""WITH {EVENTS} SELECT minutes_old, CASE WHEN minutes_old < 15 THEN 'healthy' WHEN minutes_old <= 60
  THEN 'warning' ELSE 'critical' END AS status FROM (
  SELECT date_sub('minute', max(_loaded_at), TIMESTAMP '2024-01-31 00:30:00') AS minutes_old FROM usage_events)""",
    "dq_duplicates": f"WITH {SUBSCRIPTIONS} SELECT id, count(*) AS row_count FROM raw_subscriptions GROUP BY 1 HAVING count(*) > 1",
    "dq_declared_tests": _declared_tests(),
    "dq_suite": f"""WITH {FACTS}
  SELECT 'row_volume' AS check_name, deviation AS measured, CAST(0.3 AS DOUBLE) AS threshold, {_judged('deviation', '0.3')}
  FROM ({_volume('raw_subscriptions', '2001-07-20')})
  UNION ALL SELECT 'mrr_reconciliation', diff, CAST(0.0001 AS DOUBLE), {_judged('diff', '0.0001')}
  FROM ({_mrr("CAST(_loaded_at AS DATE) = DATE '2001-07-20'")})
  UNION ALL SELECT 'freshness_staging', CAST(hours_old AS DOUBLE), CAST(6 AS DOUBLE), {_judged('hours_old', '6')}
  FROM (SELECT date_sub('hour', max(_loaded_at), TIMESTAMP '2001-08-15') AS hours_old FROM staged)""",
    "row_counts_union": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "top10_expensive": """SELECT 'job_' || o_orderkey AS job_id, o_orderpriority AS query, 'user_' || o_custkey AS user_email,
  CAST(floor(o_totalprice * 1000000) AS BIGINT) / 1024 / 1024 / 1024 AS gb_processed,
  CAST(floor(o_totalprice) AS BIGINT) / 1000 / 60 AS slot_minutes, o_orderdate AS creation_time
  FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-15' - INTERVAL 365 DAY AND o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'
  ORDER BY CAST(floor(o_totalprice * 1000000) AS BIGINT) DESC, job_id LIMIT 10""",
    "lag_status": """SELECT *, CASE WHEN total_lag < 1000 THEN 'healthy' WHEN total_lag <= 10000 THEN 'warning' ELSE 'critical' END AS status
  FROM (SELECT event_type AS topic, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS total_lag FROM events GROUP BY 1)""",
    "age_bands": """SELECT CASE WHEN days >= 1500 THEN 'old' WHEN days >= 365 THEN 'settled' ELSE 'recent' END AS band,
  count(*) AS order_count, max(days) AS oldest_days
  FROM (SELECT date_sub('day', o_orderdate, TIMESTAMP '2001-08-15') AS days FROM orders) GROUP BY 1""",
    "flatten_payload": f"SELECT *, TIMESTAMP '2024-11-01 02:15:00' AS _loaded_at FROM ({PAYLOAD})",
    "ingest_landed_json": PAYLOAD,
    "csv_extract": f"""WITH {ACCOUNTS} SELECT * EXCLUDE (account_sk), CAST(NULL AS VARCHAR) AS _source_system,
  updated_at + INTERVAL 1 DAY AS _loaded_at FROM account_keys""",
    "run_results_explode": f"SELECT DATE '2024-11-01' AS run_date, TIMESTAMP '2024-11-01' AS pipeline_run_at, {NODES}",
    "run_results_recorded": f"""SELECT DATE '2024-11-01' AS run_date, {NODES}
  UNION ALL SELECT DATE '2024-11-02' AS run_date, {NODES}""",
    "ingest_guard": """SELECT count(*) AS row_count, CAST(2 AS INTEGER) AS refused
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "seed_load": f"""WITH {EVENTS}, {SUBSCRIPTIONS}, {ACCOUNTS}
  SELECT 'accounts' AS table_name, count(*) AS row_count, count(CASE WHEN CAST(substr(account_id, 5) AS BIGINT) % 50 <> 7 THEN 1 END) AS checksum FROM accounts
  UNION ALL SELECT 'users', count(*), count(account_id) FROM (SELECT DISTINCT user_id, account_id FROM usage_events)
  UNION ALL SELECT 'subscriptions', count(*), CAST(sum(try_cast(amount AS BIGINT)) AS BIGINT) FROM raw_subscriptions
  UNION ALL SELECT 'usage_events', count(*), CAST(sum(event_timestamp) AS BIGINT) FROM usage_events
  UNION ALL SELECT 'invoices', count(*), CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) FROM orders
  UNION ALL SELECT 'invoice_line_items', count(*), CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) FROM lineitem""",
    "day_arguments": """WITH told AS (
    SELECT o_orderkey % 5 AS way, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderdate AS DATE)
      WHEN 3 THEN try_cast(strftime(o_orderdate, '%Y-%m-') || '31' AS DATE) END AS day FROM orders)
  SELECT way, count(*) AS row_count, count(day) AS days, max(day) AS latest FROM told GROUP BY way""",
    "stream_lake": LANDED,
    "stream_lake_timed": LANDED,
    "stream_lake_manifest": f"""WITH {MESSAGES} SELECT count(*) AS record_count, min(event_timestamp) AS min_event_timestamp,
  max(event_timestamp) AS max_event_timestamp FROM messages WHERE NOT broken""",
    "stream_quarantine": f"WITH {MESSAGES} SELECT truncated, CAST(_kafka_offset AS BIGINT) AS _kafka_offset, _kafka_partition FROM messages WHERE broken",
    "stream_raw_event_mix": f"""WITH {MESSAGES}, latest AS (
  SELECT * FROM messages WHERE NOT broken QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _kafka_offset DESC) = 1)
  SELECT lower(trim(event_type)) AS event_type, count(*) AS event_count, count(DISTINCT account_id) AS unique_accounts
  FROM latest GROUP BY 1""",
    "stream_dedup": f"WITH {MESSAGES} SELECT DISTINCT event_id, event_timestamp FROM messages WHERE NOT broken",
    "stream_dedup_bounded": f"WITH {MESSAGES} SELECT DISTINCT event_id, event_timestamp FROM messages WHERE NOT broken",
    "keyed_messages": f"WITH {LATEST_EVENTS} SELECT account_id AS message_key, event_id, event_timestamp, metadata FROM latest_events",
}
