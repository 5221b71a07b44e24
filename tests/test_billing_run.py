from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from test_billing import accounts, raw_book, raw_subscription
from usageledger.operators.checks import ChecksFailed
from usageledger.operators.history import apply_snapshot, open_history
from usageledger.plans import billing, billing_run
from usageledger.plans.billing_run import run_billing, run_facts, run_snapshot
from usageledger.schemas import RAW_SUBSCRIPTIONS

FACTS = ["subscription_id", "account_sk", "subscription_status"]


def land(frame, base, table, mode="append"):
    frame.write.mode(mode).parquet(f"{base}/raw/{table}")


def test_layers_build_and_then_grow(spark, tmp_path):
    base = str(tmp_path)
    land(accounts(spark), base, "raw_accounts")
    land(raw_book(spark), base, "raw_subscriptions")
    tables = run_billing(spark, base, datetime(2024, 11, 1, 4))
    assert tables["fct_subscriptions"].count() == 24
    assert tables["rpt_account_overview"].count() == 20
    assert (tmp_path / "transform" / "fct_subscriptions" / "started_month=2023-01-01").is_dir()

    update = [
        raw_subscription(0, 1, "growth", "cancelled", datetime(2024, 11, 2), created=1704067200),
        raw_subscription(99, 2, "starter", "active", datetime(2024, 11, 2)),
    ]
    land(spark.createDataFrame(update, RAW_SUBSCRIPTIONS), base, "raw_subscriptions")
    tables = run_billing(spark, base, datetime(2024, 11, 2, 4))
    facts = {r.subscription_id: r for r in tables["fct_subscriptions"].collect()}
    assert len(facts) == 25
    assert facts["sub_0"].subscription_status == "cancelled"
    assert str(facts["sub_0"].started_month) == "2024-01-01"
    full = run_billing(spark, base, datetime(2024, 11, 2, 5), full_refresh=True)["fct_subscriptions"]
    assert {r.subscription_id: r.mrr_amount for r in full.collect()} == {k: r.mrr_amount for k, r in facts.items()}


def test_failed_tests_stop_the_run(spark, tmp_path):
    base = str(tmp_path)
    land(accounts(spark), base, "raw_accounts")
    land(raw_book(spark).withColumn("currency", F.lit("euro")), base, "raw_subscriptions")
    with pytest.raises(ChecksFailed, match="length_currency"):
        run_billing(spark, base, datetime(2024, 11, 1))
    assert not (tmp_path / "transform").exists()


def test_snapshots_version_the_history(spark, tmp_path):
    path = str(tmp_path / "snap")
    first = run_snapshot(spark, accounts(spark), path, datetime(2024, 9, 2))
    assert first.count() == 20
    later = accounts(spark, datetime(2024, 10, 1), skip={3})
    for _ in range(2):  # a repeated run gives the same history
        second = run_snapshot(spark, later, path, datetime(2024, 10, 2))
        assert second.count() == 39
        assert second.where("dbt_valid_to is null").count() == 19
        assert second.where("account_id = 'acc_3'").first().dbt_valid_to == datetime(2024, 10, 2)
    third = run_snapshot(spark, accounts(spark, datetime(2024, 10, 5)), path, datetime(2024, 10, 6))
    assert third.count() == 39 + 20  # 19 moved on, one came back
    assert sorted(p.name for p in (tmp_path / "snap" / "current").glob("run=*")) == [
        "run=20241002000000", "run=20241006000000",
    ]
    expected = open_history(accounts(spark), "account_id")
    for extract, at in ((later, datetime(2024, 10, 2)), (accounts(spark, datetime(2024, 10, 5)), datetime(2024, 10, 6))):
        expected = apply_snapshot(expected, extract, "account_id", at)
    assertDataFrameEqual(third, expected.select(*third.columns))
    with pytest.raises(ValueError, match="twice"):
        run_snapshot(spark, accounts(spark).union(accounts(spark)), path, datetime(2024, 10, 7))
    with pytest.raises(ValueError, match="after"):
        run_snapshot(spark, accounts(spark), path, datetime(2024, 9, 9))


def test_a_changed_account_moves_its_facts(spark, tmp_path):
    base = str(tmp_path)
    land(accounts(spark), base, "raw_accounts")
    land(raw_book(spark), base, "raw_subscriptions")
    run_billing(spark, base, datetime(2024, 11, 1, 4))
    land(accounts(spark, datetime(2024, 11, 1, 12)), base, "raw_accounts", "overwrite")
    update = [raw_subscription(99, 2, "starter", "active", datetime(2024, 11, 2))]
    land(spark.createDataFrame(update, RAW_SUBSCRIPTIONS), base, "raw_subscriptions")
    tables = run_billing(spark, base, datetime(2024, 11, 2, 4))
    current = {r.account_id: r.dbt_scd_id for r in tables["snap_accounts"].where("dbt_valid_to is null").collect()}
    facts = tables["fct_subscriptions"].collect()
    assert len(facts) == 25 and all(r.account_sk == current.get(r.account_id) for r in facts)


def test_a_failing_gate_leaves_the_facts_alone(spark, tmp_path):
    path, history = str(tmp_path / "facts"), open_history(accounts(spark), "account_id")
    staged = billing.stg_subscriptions(raw_book(spark))
    before = sorted(run_facts(spark, staged, history, path).collect())
    extra = spark.createDataFrame([raw_subscription(99, 2, "starter", "active", datetime(2024, 12, 2))], RAW_SUBSCRIPTIONS)
    grown = billing.stg_subscriptions(raw_book(spark).union(extra))
    seen = []

    def refuse(facts):
        seen.append(facts.count())
        raise ChecksFailed("no")

    with pytest.raises(ChecksFailed):
        run_facts(spark, grown, history, path, gate=refuse)
    assert seen == [25] and sorted(spark.read.parquet(path).select(*FACTS).collect()) == sorted(
        tuple(r[c] for c in FACTS) for r in before
    )


@pytest.mark.parametrize("stop_at", ["closed", "current"])
def test_an_unfinished_snapshot_leaves_no_versions(spark, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "snap")
    run_snapshot(spark, accounts(spark), path, datetime(2024, 9, 2))
    later, whole = accounts(spark, datetime(2024, 10, 1)), billing_run.rebuild

    def die(rows, target, *more):
        if f"/{stop_at}/" in target:
            raise RuntimeError("the driver is gone")
        whole(rows, target, *more)

    with monkeypatch.context() as broken:
        broken.setattr(billing_run, "rebuild", die)
        with pytest.raises(RuntimeError):
            run_snapshot(spark, later, path, datetime(2024, 10, 2))
    assert billing_run.read_history(spark, path).count() == 20
    history = run_snapshot(spark, later, path, datetime(2024, 10, 3))
    assert history.count() == history.select("dbt_scd_id").distinct().count() == 40
