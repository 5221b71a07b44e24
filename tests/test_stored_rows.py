"""What merges and loads store besides their tables: a load's own rows and few of the old ones."""

import uuid
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from compare import plan_text
from test_billing import accounts, raw_book
from test_usage_index import FIRST, event, land, same
from usageledger.functions.columns import surrogate_key
from usageledger.operators.history import apply_snapshot, open_history
from usageledger.plans import billing, billing_run, usage_index
from usageledger.sinks import versions
from usageledger.workload import queries


@pytest.fixture
def stored(spark, tmp_path, monkeypatch):
    """Keeps scratch tables; the rows of all of them."""
    kept = tmp_path / "scratch"
    for module in (versions, usage_index, billing_run):
        monkeypatch.setattr(module, "scratch_path", lambda _, label: f"{kept}/{label}-{uuid.uuid4().hex}")
        if hasattr(module, "drop_folder"):
            monkeypatch.setattr(module, "drop_folder", lambda *_: None)
    return lambda: sum(spark.read.parquet(str(p)).count() for p in {f.parent for f in kept.rglob("*.parquet")})


def _two_loads(spark, raw):
    land(spark, raw, *[event(n, n % 40, 0, f"u{n % 9}") for n in range(600)])
    # Ten events again, five of them on another day, and an older copy that loses by its position.
    again = [event(n, n % 40 if n % 2 else 100, 1, "u99", offset=1000 + n) for n in range(0, 100, 10)]
    land(spark, raw, *again, *[event(n, 5, 1) for n in range(600, 640)])
    land(spark, raw, event(20, 7, 0, "u5", offset=-1))


def test_a_load_stores_no_old_events_but_those_it_meets(spark, tmp_path, stored):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    _two_loads(spark, raw)
    usage_index.load_days(spark, raw, state, FIRST)
    before = stored()
    assert usage_index.load_days(spark, raw, state, FIRST + timedelta(days=1))["events"] == 50
    # The 50 arrived events, and four narrow tables of the ten that were there.
    assert stored() - before <= 100
    same(spark, raw, state)


def test_keys_too_many_to_broadcast_give_the_same(spark, tmp_path, monkeypatch):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    monkeypatch.setattr(versions, "BROADCAST_KEYS", 0)
    _two_loads(spark, raw)
    for n in (1, 0):
        usage_index.load_days(spark, raw, state, FIRST + timedelta(days=n))
    usage_index.load_days(spark, raw, state, FIRST, FIRST + timedelta(days=1))
    same(spark, raw, state)
    assert usage_index.read_state(spark, state, "latest").count() == 640


def test_a_fact_run_stores_its_updates_once(spark, tmp_path, stored):
    path, staged = str(tmp_path / "facts"), billing.stg_subscriptions(raw_book(spark))
    history = open_history(accounts(spark), "account_id")
    facts = billing_run.run_facts(spark, staged, history, path)
    assert facts.count() == 24 and stored() == 24


def test_moved_facts_are_not_stored_beside_the_table(spark, tmp_path, stored):
    path, staged = str(tmp_path / "facts"), billing.stg_subscriptions(raw_book(spark))
    history = open_history(accounts(spark), "account_id")
    billing_run.run_facts(spark, staged, history, path)
    before, changed = stored(), datetime(2024, 11, 1)
    history = apply_snapshot(history, accounts(spark, changed), "account_id", changed)
    facts = billing_run.run_facts(spark, staged, history, path)
    current = {r.account_id: r.dbt_scd_id for r in history.where("dbt_valid_to is null").collect()}
    found = facts.collect()
    assert len(found) == 24 and all(r.account_sk == current.get(r.account_id) for r in found)
    # The changed accounts with their versions, and no fact.
    assert stored() - before == len({r.account_id for r in found} & current.keys())


def test_keys_of_subscriptions_are_made_where_facts_are_written(spark, tmp_path, stored):
    path, staged = str(tmp_path / "facts"), billing.stg_subscriptions(raw_book(spark))
    history = open_history(accounts(spark), "account_id")
    billing_run.run_facts(spark, staged, history, path)
    # One stored key was made otherwise; it stays.
    wanted = F.when(F.col("subscription_id") == "sub_3", "x3").otherwise(surrogate_key("subscription_id"))
    foreign = versions.read(spark, path).withColumn("subscription_sk", wanted)
    base = versions.version(spark, path)
    files = versions.add_files(foreign, path, billing_run.FACT_MONTH, billing_run.FACT_CLUSTER)
    versions.publish(spark, path, files, foreign.schema, base.mark, after=base.number)
    changed = datetime(2024, 11, 1)
    history = apply_snapshot(history, accounts(spark, changed), "account_id", changed)
    found = billing_run.run_facts(spark, staged, history, path)
    assert found.count() == found.where(F.col("subscription_sk") == wanted).count() == 24
    updates = [str(p) for p in (tmp_path / "scratch").glob("merge-result-*/updates")]
    kept = spark.read.parquet(*updates)
    assert kept.count() == 24 and kept.where("subscription_sk is not null").isEmpty()


def test_facts_are_laid_out_with_their_keys_and_compressed(spark, tmp_path):
    path, staged = str(tmp_path / "facts"), billing.stg_subscriptions(raw_book(spark))
    billing_run.run_facts(spark, staged, open_history(accounts(spark), "account_id"), path)
    for name in versions.version(spark, path).files:
        file = pq.ParquetFile(f"{path}/{name}")
        order = file.read(columns=billing_run.FACT_CLUSTER).to_pylist()
        assert [tuple(r.values()) for r in order] == sorted(tuple(r.values()) for r in order)
        assert {file.metadata.row_group(0).column(c).compression for c in range(file.metadata.num_columns)} == {"ZSTD"}


def test_two_fact_runs_stage_the_raw_rows_once(spark, monkeypatch):
    given, run = [], queries.run_facts

    def seen(spark, staged, *others):
        given.append(plan_text(staged))
        return run(spark, staged, *others)

    monkeypatch.setattr(queries, "run_facts", seen)
    for name in ("facts_after_account_changes", "merge_stopped_midway"):
        assert queries.REGISTRY[name](spark, "/root/testdata/sf0.001").count() == 1500
    assert len(given) == 4 and not any("Window" in plan or "orders" in plan for plan in given)
