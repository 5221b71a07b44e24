"""What the physical plans must look like."""

import re

import pytest

from usageledger.workload.queries import REGISTRY
from compare import plan_text

TABLES = "/root/testdata/sf0.001"


def columns_read(plan, table):
    scan = next(line for line in plan.splitlines() if f"/{table}.parquet" in line)
    listed = re.search(r"FileScan parquet \[(.*?)\]", scan).group(1)
    return {column.split("#")[0] for column in listed.split(",")}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_rows_and_no_cross_join(spark, name):
    plan = plan_text(REGISTRY[name](spark, TABLES))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, REPARTITION"):
        assert word not in plan


def test_scans_read_only_what_is_used(spark):
    queries = REGISTRY
    assert columns_read(plan_text(queries["usage_daily"](spark, TABLES)), "events") == {"event_id", "ts", "user_id", "event_type"}
    assert columns_read(plan_text(queries["dq_range"](spark, TABLES)), "orders") == {"o_orderkey", "o_totalprice"}
    assert columns_read(plan_text(queries["dq_relationships"](spark, TABLES)), "lineitem") == {"l_orderkey"}


def test_daily_metrics_need_three_shuffles(spark):
    # dedup by event, distinct users and sessions, then the grain
    plan = plan_text(REGISTRY["usage_daily"](spark, TABLES))
    assert plan.count("Exchange hashpartitioning") == 3


def below(plan):
    """Every shuffle of a plan with the lines under it."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            end = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            yield line, "\n".join(lines[i + 1 : end])


@pytest.mark.parametrize("name, bound", [("usage_recompute_days", "LeftSemi, BuildRight"), ("usage_recent_days", "event_timestamp")])
def test_events_of_other_days_are_shuffled_without_their_columns(spark, name, bound):
    shuffles = list(below(plan_text(REGISTRY[name](spark, TABLES))))
    wide = [rest for _, rest in shuffles if "session_id" in rest]
    narrow = [rest for _, rest in shuffles if "session_id" not in rest]
    assert wide and len(narrow) >= 2
    # Only rows of the wanted days carry what the metrics read into a shuffle.
    assert all(bound in rest for rest in wide)


def test_fact_joins_broadcast_only_the_hot_key_list(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(REGISTRY["fct_subscriptions"](spark, TABLES))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # facts and dimension are each marked by the hot-key list and then sort-merge joined
    assert plan.count("BroadcastHashJoin") == 2
    assert re.search(r"SortMergeJoin \[account_id#\d+, _slice#\d+L\]", plan)
