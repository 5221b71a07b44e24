from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from usageledger.operators.evolve import append_evolving, schema_drift
from usageledger.operators import merge
from usageledger.operators.merge import merge_upsert, newer_rows, publish_merge, stage_merge
from usageledger.operators.retention import expire_path, expired_days, unexpired
from usageledger.sinks.files import drop_partitions, dry_run, rebuild, write_partitioned

SHAPE = "k string, v int, month date, _loaded_at timestamp"
JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def rows(spark, *values):
    return spark.createDataFrame([(k, v, m, datetime(2024, 1, d)) for k, v, m, d in values], SHAPE)


def read(spark, path):
    return spark.read.parquet(path).select("k", "v", "month", "_loaded_at")


def test_merge_twice_is_merge_once(spark):
    target = rows(spark, ("a", 1, JAN, 1), ("b", 2, JAN, 1))
    updates = rows(spark, ("b", 3, FEB, 2), ("c", 4, FEB, 2))
    once = merge_upsert(target, updates, "k")
    assert {r.k: r.v for r in once.collect()} == {"a": 1, "b": 3, "c": 4}
    assertDataFrameEqual(merge_upsert(once, updates, "k"), once)


def test_merge_appends_new_columns(spark):
    target = rows(spark, ("a", 1, JAN, 1))
    merged = merge_upsert(target, rows(spark, ("b", 2, JAN, 1)).withColumn("extra", F.lit("x")), "k")
    assert {r.k: r.extra for r in merged.collect()} == {"a": None, "b": "x"}


def test_high_water_mark(spark):
    staged = rows(spark, ("a", 1, JAN, 1), ("b", 2, JAN, 2), ("c", 3, JAN, 3))
    target = staged.where("k <> 'c'")
    assert [r.k for r in newer_rows(staged, target).collect()] == ["c"]
    assert newer_rows(staged, staged.limit(0)).count() == 3
    assert newer_rows(staged, None).count() == 3
    assert newer_rows(staged, target, full_refresh=True).count() == 3
    # equal load times are not new
    assert newer_rows(target, target).isEmpty()


def test_partitioned_merge_moves_rows_and_drops_emptied_months(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_partitioned(rows(spark, ("a", 1, JAN, 1), ("b", 2, FEB, 1), ("c", 3, MAR, 1)), path, "month", ["k"])
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "facts" / "month=2024-03-01").iterdir()}
    staged = stage_merge(spark, path, rows(spark, ("b", 9, JAN, 2)), "k", "month")
    for _ in range(2):  # publishing again after a failure gives the same table
        publish_merge(spark, staged, path, "month", ["k"])
        got = {(r.k, r.v, r.month) for r in read(spark, path).collect()}
        assert got == {("a", 1, JAN), ("b", 9, JAN), ("c", 3, MAR)}
    assert not (tmp_path / "facts" / "month=2024-02-01").exists()
    assert {f.name: f.stat().st_mtime_ns for f in (tmp_path / "facts" / "month=2024-03-01").iterdir()} == untouched


def test_partitioned_merge_with_unknown_month(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_partitioned(rows(spark, ("a", 1, None, 1), ("b", 2, FEB, 1)), path, "month")
    publish_merge(spark, stage_merge(spark, path, rows(spark, ("a", 5, FEB, 2)), "k", "month"), path, "month")
    assert {(r.k, r.v, r.month) for r in read(spark, path).collect()} == {("a", 5, FEB), ("b", 2, FEB)}


def test_a_merge_that_died_is_repaired_by_the_next_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "facts")
    write_partitioned(rows(spark, ("a", 1, JAN, 1), ("b", 2, FEB, 1)), path, "month")
    moved = rows(spark, ("a", 5, FEB, 2))

    def die(*_, **__):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(merge, "write_partitioned", die)
        with pytest.raises(RuntimeError):
            publish_merge(spark, stage_merge(spark, path, moved, "k", "month"), path, "month")
    # the mark has not moved, so the same update comes again
    publish_merge(spark, stage_merge(spark, path, moved, "k", "month"), path, "month")
    assert sorted((r.k, r.v, r.month) for r in read(spark, path).collect()) == [("a", 5, FEB), ("b", 2, FEB)]


def test_merge_rejects_two_updates_of_one_key(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_partitioned(rows(spark, ("a", 1, JAN, 1)), path, "month")
    with pytest.raises(ValueError):
        stage_merge(spark, path, rows(spark, ("a", 2, JAN, 2), ("a", 3, JAN, 2)), "k", "month")


def test_write_replaces_only_partitions_with_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_partitioned(rows(spark, ("a", 1, JAN, 1), ("b", 2, FEB, 1)), path, "month", ["k"]) == 2
    assert write_partitioned(rows(spark, ("c", 3, FEB, 1)), path, "month", ["k"]) == 1
    assert {r.k for r in read(spark, path).collect()} == {"a", "c"}
    write_partitioned(rows(spark, ("d", 4, FEB, 1)), path, "month", append=True)
    assert {r.k for r in read(spark, path).collect()} == {"a", "c", "d"}
    rebuild(rows(spark, ("e", 5, MAR, 1)), path, "month")
    assert {r.k for r in read(spark, path).collect()} == {"e"}


def test_files_are_sorted_by_cluster_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    shuffled = spark.range(2000).select(
        F.concat(F.lit("k"), F.lpad((F.col("id") * 37 % 2000).cast("string"), 4, "0")).alias("k"),
        F.add_months(F.lit(JAN), (F.col("id") % 3).cast("int")).alias("month"),
    )
    write_partitioned(shuffled.repartition(5), path, "month", ["k"])
    for file in (tmp_path / "t").rglob("*.parquet"):
        keys = [r.k for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert keys == sorted(keys)


def test_dry_run_counts_and_shows_without_writing(spark):
    result = dry_run(rows(spark, *[(f"k{i}", i, JAN, 1) for i in range(8)]))
    assert result["rows"] == 8 and len(result["preview"]) == 5


def test_retention(spark, tmp_path):
    path = str(tmp_path / "raw")
    events = spark.createDataFrame(
        [("old", date(2024, 1, 1)), ("edge", date(2024, 1, 11)), ("new", date(2024, 1, 20)), ("none", None)],
        "id string, load_date date",
    )
    as_of = date(2024, 1, 21)
    assert {r.id for r in unexpired(events, as_of, 10).collect()} == {"edge", "new", "none"}
    assert [r.load_date for r in expired_days(events, as_of, 10).collect()] == [date(2024, 1, 1)]
    write_partitioned(events, path, "load_date")
    assert expire_path(spark, path, as_of, 10) == [date(2024, 1, 1)]
    assert {r.id for r in spark.read.parquet(path).collect()} == {"edge", "new", "none"}
    drop_partitions(spark, path, "load_date", [None])
    assert {r.id for r in spark.read.parquet(path).collect()} == {"edge", "new"}


def test_append_and_drift(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    new = spark.createDataFrame([(2, 5.0)], "a int, c double")
    assert [tuple(r) for r in append_evolving(old, new).orderBy("a").collect()] == [(1, "x", None), (2, None, 5.0)]
    found = {r.column_name: r.change for r in schema_drift(new.withColumn("a", F.lit("t")), old.schema).collect()}
    assert found == {"a": "type_changed", "b": "missing", "c": "added"}
    assert schema_drift(old, old.schema).isEmpty()
