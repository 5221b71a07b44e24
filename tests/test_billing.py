"""Subscriptions of a small reference book, with the totals they must give."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from usageledger.operators.checks import failing
from usageledger.operators.history import apply_snapshot, open_history
from usageledger.plans import billing, quality, reports
from usageledger.schemas import ACCOUNTS, RAW_SUBSCRIPTIONS

# Plan and price in cents; accounts per plan and status.
PRICES = {"starter": 4900, "growth": 14900, "enterprise": 49900, "enterprise_annual": 598800}
BOOK = {
    ("growth", "active"): [1, 6, 9, 16, 19],
    ("growth", "cancelled"): [18, 4],
    ("enterprise", "active"): [2, 12, 17, 1],
    ("enterprise_annual", "active"): [4, 10, 14],
    ("starter", "active"): [3, 7, 13, 19, 13],
    ("starter", "trialing"): [5, 15],
    ("starter", "cancelled"): [8],
    ("starter", "past_due"): [11],
    ("starter", "incomplete"): [20],
}
INACTIVE = {8, 18}
LOADED = datetime(2024, 11, 1, 2, 15)


def raw_subscription(n, account, plan, status, loaded=LOADED, **over):
    row = {
        "id": f"sub_{n}", "customer": f"acc_{account}", "plan_id": f"plan_{plan}", "status": status,
        "billing_interval": "year" if plan.endswith("annual") else "month", "currency": "USD",
        "amount": PRICES[plan], "created": 1673740800, "canceled_at": 0, "ended_at": 0,
        "trial_start": 0, "trial_end": 0, "_source_system": "stripe", "_loaded_at": loaded,
        "_pipeline_run_date": loaded.date(), **over,
    }
    return tuple(row[f] for f in RAW_SUBSCRIPTIONS.fieldNames())


def raw_book(spark):
    listed = [(plan, status, a) for (plan, status), accounts in BOOK.items() for a in accounts]
    rows = [raw_subscription(n, a, plan, status) for n, (plan, status, a) in enumerate(listed)]
    rows.append(raw_subscription(0, 1, "growth", " TRIALING", datetime(2024, 10, 31, 2, 15)))
    return spark.createDataFrame(rows, RAW_SUBSCRIPTIONS)


def accounts(spark, updated=datetime(2024, 9, 1), skip=()):
    rows = [
        (f"acc_{n}", f"Account {n}", "SaaS", "SMB", "Europe", "Growth", "csm_1", n not in INACTIVE,
         datetime(2023, 1, 1), updated, "crm", LOADED)
        for n in range(1, 21) if n not in skip
    ]
    return spark.createDataFrame(rows, ACCOUNTS)


def book(spark, **options):
    staged = billing.stg_subscriptions(raw_book(spark), **options)
    history = open_history(accounts(spark), "account_id")
    return staged, history, billing.fct_subscriptions(staged, history)


def test_totals(spark):
    staged, _, _ = book(spark)
    total = staged.agg(F.count("*"), F.sum("mrr_amount")).first()
    assert tuple(total) == (24, Decimal("21493.000000"))


def test_mrr_by_status(spark):
    _, _, facts = book(spark)
    got = {r.subscription_status: (r.subscription_count, float(r.total_mrr)) for r in billing.mrr_by_status(facts).collect()}
    assert got == {
        "active": (17, 20950.0), "cancelled": (3, 347.0), "incomplete": (1, 49.0),
        "past_due": (1, 49.0), "trialing": (2, 98.0),
    }


def test_plan_metrics(spark):
    _, _, facts = book(spark)
    got = {
        r.plan_id: (
            r.total_subscriptions, r.active_subscriptions, r.cancelled_subscriptions, r.trialing_subscriptions,
            r.at_risk_subscriptions, float(r.plan_active_mrr), float(r.avg_active_mrr), r.unique_accounts,
        )
        for r in billing.plan_metrics(facts).collect()
    }
    assert got == {
        "plan_enterprise": (4, 4, 0, 0, 0, 1996.0, 499.0, 4),
        "plan_enterprise_annual": (3, 3, 0, 0, 0, 17964.0, 5988.0, 3),
        "plan_growth": (7, 5, 2, 0, 0, 745.0, 149.0, 7),
        "plan_starter": (10, 5, 1, 2, 2, 245.0, 49.0, 9),
    }


def counted(frame, column):
    return {r[column]: r["count"] for r in frame.groupBy(column).count().collect()}


def test_report_labels(spark):
    _, history, facts = book(spark)
    monthly = reports.subscription_monthly(facts, history)
    assert counted(monthly, "value_tier") == {"High Value": 3, "Medium Value": 9, "Low Value": 5, "Non-Revenue": 7}
    assert counted(monthly, "health_status") == {"Active": 17, "Cancelled": 3, "At Risk": 2, "Trialing": 2}
    assert counted(monthly, "billing_type") == {"Annual": 3, "Monthly": 21}
    overview = reports.account_overview(history, billing.account_metrics(facts), LOADED)
    assert counted(overview, "account_health_segment") == {
        "Enterprise": 3, "Growth": 1, "Inactive": 2, "No Subscription": 4, "Starter": 10,
    }
    assert counted(overview, "product_adoption") == {
        "Dual-Product": 3, "Single-Product": 11, "No Active Products": 6,
    }
    assert overview.count() == 20


def test_yearly_amounts_count_as_monthly_unless_normalised(spark):
    _, _, facts = book(spark)
    annual = facts.where("plan_id = 'plan_enterprise_annual'").first()
    assert (annual.mrr_amount, annual.arr_amount) == (Decimal("5988.000000"), Decimal("71856.000000"))
    staged, _, _ = book(spark, normalize_interval=True)
    assert staged.where("billing_interval = 'year'").first().mrr_amount == Decimal("499.000000")


def test_staging_edges(spark):
    raw = spark.createDataFrame([
        raw_subscription(1, 1, "starter", " Canceled ", currency=" eur", created=0, canceled_at=1714521600),
        raw_subscription(2, 1, "starter", "active", id=None),
        raw_subscription(3, 1, "starter", "active", customer=None),
        raw_subscription(4, 1, "starter", "active"),
        raw_subscription(4, 1, "starter", "active", datetime(2024, 11, 2), customer=None),
    ], RAW_SUBSCRIPTIONS)
    row, = billing.stg_subscriptions(raw).collect()
    assert (row.subscription_id, row.subscription_status, row.currency) == ("sub_1", "canceled", "EUR")
    assert str(row.started_at) == "1970-01-01 00:00:00" and str(row.cancelled_at) == "2024-05-01 00:00:00"
    assert row.ended_at is None
    aliased = billing.stg_subscriptions(raw, status_aliases={"canceled": "cancelled"})
    assert aliased.first().subscription_status == "cancelled"


def test_flattened_payload_names_the_account_differently(spark):
    raw = raw_book(spark).withColumnRenamed("customer", "customer_id")
    assert billing.stg_subscriptions(raw).where("account_id is null").isEmpty()
    both = raw.withColumn("customer", F.lit(None).cast("string"))
    assert billing.stg_subscriptions(both).count() == 24


def test_facts_without_account(spark):
    staged, _, _ = book(spark)
    partial = open_history(accounts(spark, skip={1}), "account_id")
    facts = billing.fct_subscriptions(staged, partial)
    assert facts.count() == 24
    assert {r.account_id for r in facts.where("account_sk is null").collect()} == {"acc_1"}


def test_facts_use_the_current_version(spark):
    staged, history, _ = book(spark)
    later = apply_snapshot(history, accounts(spark, datetime(2024, 10, 1)), "account_id", LOADED)
    assert later.count() == 40
    facts = billing.fct_subscriptions(staged, later)
    assert facts.count() == 24
    current = {r.dbt_scd_id for r in later.where("dbt_valid_to is null").collect()}
    assert {r.account_sk for r in facts.collect()} <= current


def overviews(spark, cases, as_of=datetime(2024, 1, 1)):
    """One report row per case; a case overrides the metrics, `is_active` or `known`."""
    base = {
        "total_subscriptions": 1, "active_subscriptions": 1, "cancelled_subscriptions": 0,
        "trialing_subscriptions": 0, "total_active_mrr": 100.0, "total_active_arr": 1200.0,
        "first_subscription_at": datetime(2024, 1, 1), "latest_subscription_at": datetime(2024, 1, 1),
        "unique_plans": 1, "unique_currencies": 1,
    }
    held, metrics = [], []
    for n, case in enumerate(cases):
        case = dict(case)
        active, known = case.pop("is_active", True), case.pop("known", True)
        held.append((f"a{n:03}", "n", "i", "s", "r", "t", "c", active, datetime(2023, 12, 30, 12),
                     datetime(2023, 12, 30), "crm", LOADED))
        if known:
            metrics.append((f"a{n:03}", *{**base, **case}.values()))
    shape = (
        "account_id string, total_subscriptions int, active_subscriptions int, cancelled_subscriptions int, "
        "trialing_subscriptions int, total_active_mrr double, total_active_arr double, "
        "first_subscription_at timestamp, latest_subscription_at timestamp, unique_plans int, unique_currencies int"
    )
    history = open_history(spark.createDataFrame(held, ACCOUNTS), "account_id")
    report = reports.account_overview(history, spark.createDataFrame(metrics, shape), as_of)
    return report.orderBy("account_id").collect()


def test_segments_branch_by_branch(spark):
    none = {"active_subscriptions": 0, "total_active_mrr": 0.0}
    expected = [
        ({"is_active": False, "total_active_mrr": 5000.0}, "Inactive"),
        ({"is_active": None, "total_active_mrr": 5000.0}, "Enterprise"),
        ({"cancelled_subscriptions": 1, **none}, "Churned"),
        (none, "No Subscription"),
        *[({"total_active_mrr": m}, name) for m, name in (
            (1000.0, "Enterprise"), (999.99, "Growth"), (500.0, "Growth"), (499.99, "Starter"),
            (0.01, "Starter"), (0.0, "Free"), (-5.0, "Free"),
        )],
    ]
    got = overviews(spark, [case for case, _ in expected])
    assert [r.account_health_segment for r in got] == [name for _, name in expected]


def test_adoption_and_age(spark):
    rows = overviews(spark, [{"active_subscriptions": n} for n in (4, 3, 2, 1, 0)])
    assert [r.product_adoption for r in rows] == [
        "Multi-Product", "Multi-Product", "Dual-Product", "Single-Product", "No Active Products",
    ]
    # a day and a half is one whole day
    assert {r.account_age_days for r in rows} == {1}


def test_engagement(spark):
    as_of = datetime(2024, 12, 1)
    cases = [
        {"first_subscription_at": as_of - timedelta(days=n), "latest_subscription_at": as_of - timedelta(days=n)}
        for n in (30, 31, 90, 91, 180, 181)
    ]
    got = [r.engagement_status for r in overviews(spark, [*cases, {"total_active_mrr": 0.0}], as_of)]
    assert got == ["New", "Active", "Active", "Engaged", "Engaged", "Dormant", None]


def test_accounts_without_metrics_get_defaults(spark):
    row = overviews(spark, [{}, {"known": False}])[1]
    assert (row.total_subscriptions, row.total_mrr, row.unique_plans_subscribed, row.currencies_used) == (0, 0, 0, 1)
    assert (row.account_health_segment, row.product_adoption, row.engagement_status) == (
        "No Subscription", "No Active Products", None,
    )


def test_negative_mrr_is_found(spark):
    _, _, facts = book(spark)
    bad = facts.withColumn("mrr_amount", F.when(F.col("plan_id") == "plan_growth", -1).otherwise(F.col("mrr_amount")))
    assert failing(facts, quality.negative_mrr_check()).isEmpty()
    assert failing(bad, quality.negative_mrr_check()).count() == 5
