"""The driver tables seen as the domain's source tables.

Every mapping keeps all rows of its table; some rows get dirty values or a second,
older copy so that cleaning, deduplication and the checks have something to find.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageledger.operators.history import open_history
from usageledger.operators.lookup import hot_keys
from usageledger.session import pin_utc


# Declared, so that opening a table reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def emit(rows: DataFrame) -> DataFrame:
    """Output types that mean the same in any engine: doubles and zone-free timestamps.

    Whole numbers wider than a bigint stay exact.
    """
    casts = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz"}
    return rows.select(*[
        F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name)
        if type(f.dataType) in casts and f.dataType != T.DecimalType(38, 0) else F.col(f.name)
        for f in rows.schema.fields
    ])


def _tagged(prefix: str, *values: Column | str) -> Column:
    return F.concat(F.lit(prefix), *[F.col(v).cast("string") if isinstance(v, str) else v for v in values])


def _with_older_copy(rows: DataFrame, repeated: Column) -> DataFrame:
    """`_copy` is 0 for every row and also 1 for the repeated ones."""
    return rows.withColumn(
        "_copy", F.explode(F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )


def _loaded(stamp: Column) -> Column:
    """One day after the record's own time; the older copy on that time itself."""
    return stamp + F.make_dt_interval(F.lit(1) - F.col("_copy"))


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "events")
    stamp, n = F.col("ts").cast("timestamp"), F.col("event_id")
    kind = F.when(n % 3 == 0, F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
    return _with_older_copy(source, n % 20 == 0).select(
        _tagged("evt_", "event_id").alias("event_id"),
        F.when(n % 97 != 0, _tagged("acc_", (F.col("user_id") % 50).cast("string"))).alias("account_id"),
        _tagged("usr_", "user_id").alias("user_id"),
        F.when(F.col("_copy") == 1, "stale").otherwise(F.coalesce(kind, "event_type")).alias("event_type"),
        F.when(n % 11 != 0, _tagged(" F", (n % 7).cast("string"))).alias("feature_name"),
        F.concat_ws("_", F.lit("s"), "user_id", F.to_date(stamp)).alias("session_id"),
        F.unix_millis(stamp).alias("event_timestamp"),
        F.col("props").alias("metadata"),
        # The later copy follows the older one in the log.
        (n * 2 + 1 - F.col("_copy")).cast("int").alias("_kafka_offset"),
        (F.col("user_id") % 6).cast("int").alias("_kafka_partition"),
        _loaded(stamp).alias("_loaded_at"),
    )


LOADS = 5


def event_number() -> Column:
    """The source event's number; both copies of an event have it."""
    return F.floor(F.col("_kafka_offset") / 2)


def usage_loads(spark: SparkSession, sf_dir: str, first: date) -> DataFrame:
    """The events as LOADS daily loads, foldered by load date.

    An event in fifty has no time. The older copy may come in a later load than the other; then
    it counts. The last load brings every fortieth event again, moved 40 days back.
    """
    n, older = event_number(), F.col("event_type") == "stale"
    load = F.pmod(F.when(older, F.floor(n / 20)).otherwise(n), F.lit(LOADS)).cast("int")
    events = usage_events(spark, sf_dir).withColumns({
        "event_timestamp": F.when(n % 50 == 7, None).otherwise(F.col("event_timestamp")),
        "load_date": F.date_add(F.lit(first), load),
    })
    moved = events.where((n % 40 == 0) & ~older).withColumns({
        "event_timestamp": F.col("event_timestamp") - 40 * 86_400_000,
        "load_date": F.date_add(F.lit(first), LOADS - 1),
        "_kafka_offset": F.col("_kafka_offset") + 1_000_000_000,
    })
    return events.unionByName(moved).withColumn("_loaded_at", F.col("load_date").cast("timestamp"))


STATUS_BY_SLOT = [
    "ACTIVE ", "active", "incomplete", " Unpaid", "Active", " Cancelled", "trialing", "past_due",
]


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "orders")
    stamp, n = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey")
    started, month = F.unix_seconds(stamp), 30 * 86400
    status = F.element_at(F.array(*map(F.lit, STATUS_BY_SLOT)), (n % 8 + 1).cast("int"))
    ended = F.when(n % 8 == 5, started + month).otherwise(0)
    return _with_older_copy(source, n % 25 == 0).select(
        _tagged("sub_", "o_orderkey").alias("id"),
        # One customer in seven is unknown to the account table.
        F.concat(F.when(F.col("o_custkey") % 7 == 0, "acc_x").otherwise("acc_"), F.col("o_custkey").cast("string")).alias("customer"),
        F.col("o_orderpriority").alias("plan_id"),
        F.when(F.col("_copy") == 1, "trialing").when(n % 250 == 9, "paused").otherwise(status).alias("status"),
        F.when(n % 4 == 0, "year").when(n % 4 == 3, "week").otherwise("month").alias("billing_interval"),
        F.when(n % 5 == 0, " eur").when(n % 333 == 1, "us").otherwise("USD").alias("currency"),
        F.when(n % 500 == 3, "n/a").otherwise(F.floor("o_totalprice").cast("string")).alias("amount"),
        started.alias("created"),
        ended.alias("canceled_at"),
        ended.alias("ended_at"),
        F.when(n % 8 == 6, started).otherwise(0).alias("trial_start"),
        F.when(n % 8 == 6, started + month).otherwise(0).alias("trial_end"),
        F.lit("stripe").alias("_source_system"),
        _loaded(stamp).alias("_loaded_at"),
        F.to_date(_loaded(stamp)).alias("_pipeline_run_date"),
    )


def _account_columns(rows: DataFrame, version: Column) -> DataFrame:
    """The account as of its n-th change; every change moves the tier and the time."""
    balance = F.col("c_acctbal")
    tiers = F.array(F.lit("Free"), F.lit("Growth"), F.lit("Enterprise"))
    tier = F.when(balance < 0, 0).when(balance < 5000, 1).otherwise(2)
    created = F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval((F.col("c_custkey") % 365).cast("int"))
    updated = created + F.make_dt_interval((version * 30).cast("int"))
    return rows.select(
        _tagged("acc_", "c_custkey").alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(balance < 0, "SMB").when(balance < 5000, "Mid-Market").otherwise("Enterprise").alias("company_size_band"),
        F.col("r_name").alias("region"),
        F.element_at(tiers, ((tier + version) % 3 + 1).cast("int")).alias("account_tier"),
        _tagged("csm_", (F.col("c_nationkey") % 7).cast("string")).alias("csm_user_id"),
        F.when(F.col("c_custkey") % 50 != 7, balance >= -500).alias("is_active"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.lit("crm").alias("_source_system"),
        (updated + F.make_dt_interval(F.lit(1))).alias("_loaded_at"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account extract before any change."""
    return _account_columns(_customers(spark, sf_dir), F.lit(0))


def changed_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account extract after every account had its changes (0, 1 or 2 of them)."""
    return _account_columns(_customers(spark, sf_dir), F.col("c_custkey") % 3)


def account_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state an account ever had."""
    states = _customers(spark, sf_dir).withColumn(
        "_version", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c_custkey") % 3))
    )
    return _account_columns(states, F.col("_version"))


def account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_history(accounts(spark, sf_dir), "account_id")


def hot_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts to split in joins, counted on the raw rows' account column alone."""
    return hot_keys(
        raw_subscriptions(spark, sf_dir).select(F.col("customer").alias("account_id")), "account_id"
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        _tagged("inv_", "o_orderkey").alias("invoice_id"),
        _tagged("acc_", "o_custkey").alias("account_id"),
        _tagged("sub_", "o_orderkey").alias("subscription_id"),
        F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "open").otherwise("void").alias("status"),
        F.when(n % 41 != 0, F.lit("USD")).alias("currency"),
        F.floor(F.col("o_totalprice")).alias("total_cents"),
        F.to_date("o_orderdate").alias("due_date"),
    )


def invoice_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", F.lit("li"), "l_orderkey", "l_linenumber").alias("line_item_id"),
        # Some items point to an invoice that does not exist.
        F.concat(F.lit("inv_"), F.when(order % 101 == 0, order + 10000000).otherwise(order).cast("string")).alias("invoice_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.floor(F.col("l_extendedprice")).alias("total_cents"),
    )
