from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from usageledger import fixed_values as fv
from usageledger.operators import checks
from usageledger.plans import quality


def table(spark):
    return spark.createDataFrame(
        [(1, "a", "USD"), (2, "b", "EURO"), (2, None, None), (None, "zz", "EUR"), (None, "a", "EUR")],
        "n int, t string, c string",
    )


def failures(spark, check):
    return checks.failing(table(spark), check).count()


def test_each_rule(spark):
    assert failures(spark, checks.not_null("n")) == 2
    assert failures(spark, checks.unique("n")) == 1  # NULLs do not repeat
    assert failures(spark, checks.unique_together("n", "c")) == 1
    assert failures(spark, checks.accepted("t", ["a", "b"])) == 1
    assert failures(spark, checks.accepted("t", ["a", "b", None])) == 1
    assert failures(spark, checks.within("n", 2, 9)) == 1
    assert failures(spark, checks.within("n", 1, 2)) == 0
    assert failures(spark, checks.length_is("c", 3)) == 1
    assert failures(spark, checks.never("odd", F.col("n") == 1)) == 1


def test_summary_agrees_with_the_failing_rows(spark):
    rules = [checks.not_null("n"), checks.unique("n"), checks.accepted("t", ["a"]), checks.length_is("c", 3)]
    result = {r.check_name: (r.failures, r.status) for r in checks.run_checks(table(spark), rules, "m").collect()}
    for rule in rules:
        n = failures(spark, rule)
        assert result[rule.name] == (n, "fail" if n else "pass")


def test_row_rules_share_one_scan(spark, tmp_path):
    from compare import plan_text

    path = str(tmp_path / "t")
    table(spark).write.parquet(path)
    rules = [checks.not_null("n"), checks.not_null("t"), checks.length_is("c", 3)]
    plan = plan_text(checks.run_checks(spark.read.parquet(path), rules, "m"))
    assert plan.count("FileScan") == 1


def test_gate(spark):
    good = checks.run_checks(table(spark), [checks.accepted("c", ["USD", "EUR", "EURO"])], "m")
    checks.require_passing(good)
    with pytest.raises(checks.ChecksFailed, match="not_null_n"):
        checks.require_passing(checks.run_checks(table(spark), [checks.not_null("n")], "m"))


def test_declared_tests_are_complete():
    per_model = {name: len(rules) for name, rules in quality.declared_checks().items()}
    assert per_model == {
        "raw_accounts": 2, "raw_subscriptions": 1, "stg_subscriptions": 13, "snap_accounts": 3,
        "int_account_metrics": 4, "int_plan_metrics": 3, "fct_subscriptions": 18,
        "rpt_subscription_monthly": 14, "rpt_account_overview": 16,
    }


def loads(spark, counts):
    rows = [(datetime(2024, 1, day, 5),) for day, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "_loaded_at timestamp")


def volume(spark, counts, day=date(2024, 1, 20)):
    return quality.volume_anomaly(loads(spark, counts), day).first()


def test_volume(spark):
    row = volume(spark, {11: 1000, 12: 8, 15: 12, 20: 13})  # day 11 is out of the window
    assert (row.today, row.prior_mean, round(row.deviation, 6), row.status) == (13, 10.0, 0.3, "pass")
    assert volume(spark, {12: 10, 20: 14}).status == "fail"
    assert volume(spark, {12: 10, 20: 6}).status == "fail"
    assert volume(spark, {12: 10}).status == "no_data"
    assert volume(spark, {20: 10}).status == "no_data"
    assert volume(spark, {}).status == "no_data"


def test_reconciliation(spark):
    def layer(*amounts):
        return spark.createDataFrame(
            [("active", float(a), datetime(2024, 1, 1)) for a in amounts] + [("cancelled", 9e9, datetime(2024, 1, 1))],
            "subscription_status string, mrr_amount double, _loaded_at timestamp",
        )

    def status(left, right, ds="2024-01-01"):
        return quality.mrr_reconciliation(layer(*left), layer(*right), ds).first().status

    assert status([10000], [10001]) == "pass"
    assert status([10000], [10002]) == "fail"
    assert status([10000], [5000, 5000]) == "pass"
    assert status([], [5]) == "no_data"
    assert status([1], [2], "2024-01-02") == "no_data"


def test_freshness_counts_whole_hours(spark):
    rows = loads(spark, {1: 3})
    def at(hour, minute):
        return quality.freshness(rows, "_loaded_at", datetime(2024, 1, 1, hour, minute)).first()

    assert (at(11, 59).hours_old, at(11, 59).status) == (6, "pass")
    assert (at(12, 0).hours_old, at(12, 0).status) == (7, "fail")
    assert quality.freshness(rows.limit(0), "_loaded_at", datetime(2024, 1, 1)).first().status == "no_data"


def test_suite_has_one_row_per_check(spark):
    raw = loads(spark, {12: 10, 20: 11})
    layer = spark.createDataFrame(
        [("active", 5.0, datetime(2024, 1, 20))], "subscription_status string, mrr_amount double, _loaded_at timestamp"
    )
    suite = quality.quality_suite(
        raw, layer, layer, {"report": (layer, "_loaded_at")}, "2024-01-20", datetime(2024, 1, 20, 2)
    )
    got = {r.check_name: r.status for r in suite.collect()}
    assert got == {"row_volume": "pass", "mrr_reconciliation": "pass", "freshness_report": "pass"}
    checks.require_passing(suite)


def test_lag_grades(spark):
    offsets = spark.createDataFrame(
        [("a", 0, 500, 1), ("a", 1, 500, 0), ("b", 0, 600, 0), ("b", 1, 400, 0), ("c", 0, 10000, 0),
         ("d", 0, 10001, 0)],
        "topic string, partition int, log_end_offset bigint, current_offset bigint",
    )
    got = {r.topic: (r.total_lag, r.status) for r in quality.lag_status(offsets).collect()}
    assert got == {"a": (999, "healthy"), "b": (1000, "warning"), "c": (10000, "warning"), "d": (10001, "critical")}


def test_layer_age(spark):
    rows = loads(spark, {1: 1})
    def status(minute, limits):
        return quality.layer_age(rows, "_loaded_at", limits, datetime(2024, 1, 1, 5 + minute // 60, minute % 60)).first().status

    assert [status(m, fv.LAKE_AGE_MINUTES) for m in (14, 15, 60, 61)] == ["healthy", "warning", "warning", "critical"]
    assert [status(m, fv.STAGING_AGE_MINUTES) for m in (59, 60, 240, 241)] == ["healthy", "warning", "warning", "critical"]


def test_uniqueness_rules_share_one_shuffle(spark):
    from compare import plan_text
    from usageledger.operators import checks

    rows = spark.createDataFrame(
        [(1, "a", None), (1, "b", None), (2, "a", "x"), (2, "a", "x"), (None, "c", "y"), (None, "c", None), (3, "}", '"a'), (4, '"}', "a")],
        "k int, s string, t string",
    )
    rules = [checks.unique("k"), checks.unique_together("k", "s"), checks.unique_together("s", "t"), checks.unique("t"), checks.not_null("k")]
    found = {r.check_name: r.failures for r in checks.run_checks(rows, rules, "m").collect()}
    assert found == {checks_.name: checks.failing(rows, checks_).count() for checks_ in rules}
    assert checks.run_checks(rows.limit(0), rules, "m").where("failures > 0").isEmpty()
    plan = plan_text(checks.run_checks(rows, rules[:4], "m").select("failures"))
    assert plan.count("hashpartitioning") == 1
