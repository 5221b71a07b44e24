"""The billing layers as one run over a folder of tables, each stage behind its tests."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.functions.columns import surrogate_key
from usageledger.operators.checks import require_passing
from usageledger.operators.dedup import duplicated
from usageledger.operators.evolve import append_evolving
from usageledger.operators.history import current_versions, open_history, snapshot_moves
from usageledger.operators.lookup import hot_keys, lookup
from usageledger.plans import billing, quality, reports
from usageledger.session import pin_utc, scratch_path
from usageledger.sinks import versions
from usageledger.sinks.files import drop_folder, drop_partitions, exists, partition_folders, rebuild

FACT_CLUSTER = ["account_id", "subscription_status"]
FACT_MONTH = "started_month"


def finished_runs(spark: SparkSession, path: str) -> list[int]:
    """The runs whose open versions are kept, by the names of their complete folders."""
    return sorted(int(v) for v in partition_folders(spark, f"{path}/current", "run", complete=True))


def read_history(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The account history as of its newest run, or its newest run before a given one.

    `current/run=` holds the open versions after a run, `closed/run=` those the run
    closed. A run counts once its current versions are complete; they are written last.
    """
    runs = [r for r in finished_runs(spark, path) if before is None or r < before]
    if not runs:
        return None
    newest = max(runs)
    versions = spark.read.option("mergeSchema", True).parquet(f"{path}/current")
    closed = spark.read.option("mergeSchema", True).parquet(f"{path}/closed")
    open_now = versions.where(F.col("run") == F.lit(newest))
    return append_evolving(open_now, closed.where(F.col("run") <= F.lit(newest))).drop("run")


def run_snapshot(
    spark: SparkSession, source: DataFrame, path: str, run_at: datetime, keep_runs: int = 2
) -> DataFrame:
    """Bring the stored account history up to date and return it.

    Closed versions are written once and never again; each run writes only the open
    ones and what it closed. Repeating a run starts from the run before it and replaces
    its own folders, and a run at any later time first drops what an unfinished one
    closed, so it may die at any point. Open versions of the last `keep_runs`
    runs are kept.
    """
    if not duplicated(source, ["account_id"]).isEmpty():
        raise ValueError("the account extract holds an account twice")
    run = int(f"{run_at:%Y%m%d%H%M%S}")
    runs = finished_runs(spark, path)
    if any(other > run for other in runs):
        raise ValueError(f"the history already has a run after {run_at}")
    newest = max(runs, default=-1)
    for layer in ("closed", "current"):
        named = partition_folders(spark, f"{path}/{layer}", "run")
        drop_partitions(spark, f"{path}/{layer}", "run", [v for v in named if int(v) > newest])

    history = read_history(spark, path, before=run)
    if history is None:
        moves = open_history(source, "account_id")
    else:
        moves = snapshot_moves(current_versions(history), source, "account_id", run_at)
    staged = scratch_path(spark, "account-moves")
    moves.write.parquet(staged)
    moves = spark.read.parquet(staged)
    is_open = F.col("dbt_valid_to").isNull()
    rebuild(moves.where(~is_open), f"{path}/closed/run={run}")
    rebuild(moves.where(is_open), f"{path}/current/run={run}")
    outdated = sorted({*runs, run})[:-keep_runs]
    drop_partitions(spark, f"{path}/current", "run", outdated)
    drop_folder(spark, staged)
    return read_history(spark, path)


def _with_month(facts: DataFrame) -> DataFrame:
    return facts.withColumn(FACT_MONTH, F.trunc("started_at", "month"))


def changed_accounts(facts: DataFrame, history: DataFrame) -> DataFrame:
    """Accounts whose stored facts do not point to their current version, with that version.

    Accounts are compared one row per account and version. An account that is gone is not among them.
    """
    current = current_versions(history).select("account_id", F.col("dbt_scd_id").alias("_current"))
    known = facts.where(F.col("account_id").isNotNull()).select("account_id", "account_sk").distinct()
    outdated = known.join(current, "account_id").where(~F.col("account_sk").eqNullSafe(F.col("_current")))
    return outdated.select("account_id", "_current").distinct()


def moved_facts(facts: DataFrame, changed: DataFrame) -> DataFrame:
    """Facts of changed accounts point to the new version; all others stay as they are."""
    joined = lookup(facts, changed, "account_id", ["subscription_id"])
    return joined.withColumn("account_sk", F.coalesce("_current", "account_sk")).select(*facts.columns)


def _without_keys(facts: DataFrame) -> DataFrame:
    """Stored keys that follow from the subscription's id are left out; any other stays."""
    other = F.col("subscription_sk") != surrogate_key("subscription_id")
    return facts.withColumn("subscription_sk", F.when(other, F.col("subscription_sk")))


def _with_keys(facts: DataFrame) -> DataFrame:
    """Facts without a key get the one of `fct_subscriptions`."""
    return facts.withColumn("subscription_sk", F.coalesce("subscription_sk", surrogate_key("subscription_id")))


def _newest_load(rows: DataFrame) -> int | None:
    return rows.agg(F.unix_micros(F.max("_loaded_at"))).first()[0]


def run_facts(
    spark: SparkSession,
    staged: DataFrame,
    history: DataFrame,
    path: str,
    full_refresh: bool = False,
    gate: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Merge new staged subscriptions into the month-partitioned facts, as their next version.

    Facts of accounts that changed move to the account's current version in the same
    merge, and only files that hold a merged subscription or a changed account are written anew. The
    newest load that was merged is kept with the version, so a run that stops anywhere before it publishes
    is simply done again. Keys of subscriptions are made where the files are written, not stored with the
    updates or moved with the rows. `gate` gets the facts as they will be, in files that no version has yet, and may
    raise: those files are deleted and the table is as it was.
    """
    base = versions.version(spark, path)
    existing = None if full_refresh else versions.read(spark, path, base)
    mark = None
    if existing is not None:
        # A table from before versions has no mark but its rows.
        mark = base.mark if base.number else _newest_load(existing)
    fresh = staged if mark is None else staged.where(F.col("_loaded_at") > F.timestamp_micros(F.lit(mark)))
    facts = _with_month(billing.fct_subscriptions(fresh, history, hot_keys(fresh, "account_id")))
    facts = facts.withColumn("subscription_sk", F.lit(None).cast("string"))
    kept = scratch_path(spark, "changed-accounts")
    if existing is None:
        # Nothing of the old files stays: all of them are replaced by the staged rows.
        merge = versions.stage_merge(spark, path, versions.Version(base.number), facts, "subscription_id")
    else:
        changed_accounts(existing, history).write.parquet(kept)
        changed = spark.read.parquet(kept)
        if not duplicated(changed, ["account_id"]).isEmpty():
            raise ValueError("the history holds several current versions of one account")
        # Only files that hold a fact of a changed account meet the new versions.
        outdated = versions.holding(spark, path, base, changed, "account_id")

        def revised(rows: DataFrame) -> DataFrame:
            bare = _without_keys(rows)
            return moved_facts(bare, changed) if outdated else bare

        merge = versions.stage_merge(spark, path, base, facts, "subscription_id", more=outdated, revise=revised)
    # Older rows are in the mark already, so the stored updates tell the newest load.
    reached = max(filter(None, (mark, _newest_load(merge.fresh))), default=None)
    files = versions.place_merge(spark, path, merge, FACT_MONTH, FACT_CLUSTER, finish=_with_keys)
    if gate:
        try:
            gate(versions.read(spark, path, versions.Version(base.number, tuple(files), merge.schema.json())))
        except BaseException:
            versions.delete_files(spark, path, set(files) - set(base.files))
            raise
    versions.publish(spark, path, files, merge.schema, reached, after=base.number)
    drop_folder(spark, merge.result)
    drop_folder(spark, kept)
    # Without files of older versions the folder can be read as plain Parquet too.
    versions.clean(spark, path)
    return versions.read(spark, path)


def run_billing(
    spark: SparkSession, base: str, run_at: datetime, full_refresh: bool = False
) -> dict[str, DataFrame]:
    """raw -> staging -> history -> facts -> reports below `base`.

    The history is taken before the facts, so they point to today's account versions. A
    stage whose tests fail stops the run before the next one reads it.
    """
    pin_utc(spark)
    raw_accounts = spark.read.parquet(f"{base}/raw/raw_accounts")
    raw = spark.read.option("mergeSchema", True).parquet(f"{base}/raw/raw_subscriptions")
    rebuild(billing.stg_subscriptions(raw), f"{base}/staging/stg_subscriptions")
    staged = spark.read.parquet(f"{base}/staging/stg_subscriptions")
    require_passing(quality.check_models({
        "raw_accounts": raw_accounts, "raw_subscriptions": raw, "stg_subscriptions": staged,
    }))

    history = run_snapshot(spark, raw_accounts, f"{base}/transform/snap_accounts", run_at)
    # Tested and then read by the report, so built once.
    kept = scratch_path(spark, "account-metrics")

    def tested(facts: DataFrame) -> None:
        billing.account_metrics(facts).write.parquet(kept)
        require_passing(quality.check_models({
            "snap_accounts": history,
            "fct_subscriptions": facts,
            "int_account_metrics": spark.read.parquet(kept),
            "int_plan_metrics": billing.plan_metrics(facts),
        }))

    facts_path = f"{base}/transform/fct_subscriptions"
    facts = run_facts(spark, staged, history, facts_path, full_refresh, tested)
    per_account, per_plan = spark.read.parquet(kept), billing.plan_metrics(facts)

    hot = hot_keys(facts, "account_id")
    rebuild(
        reports.subscription_monthly(facts, history, hot),
        f"{base}/reporting/rpt_subscription_monthly", "snapshot_month", FACT_CLUSTER,
    )
    rebuild(
        reports.account_overview(history, per_account, run_at),
        f"{base}/reporting/rpt_account_overview",
    )
    monthly = spark.read.parquet(f"{base}/reporting/rpt_subscription_monthly")
    overview = spark.read.parquet(f"{base}/reporting/rpt_account_overview")
    require_passing(quality.check_models({
        "rpt_subscription_monthly": monthly, "rpt_account_overview": overview,
    }))
    drop_folder(spark, kept)
    return {
        "stg_subscriptions": staged,
        "snap_accounts": history,
        "fct_subscriptions": facts,
        "int_plan_metrics": per_plan,
        "rpt_subscription_monthly": monthly,
        "rpt_account_overview": overview,
    }
