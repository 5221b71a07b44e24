"""Incremental load into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usageledger.operators.dedup import duplicated
from usageledger.operators.evolve import append_evolving
from usageledger.session import scratch_path
from usageledger.sinks.files import drop_folder, drop_partitions, write_partitioned


def newer_rows(
    staged: DataFrame,
    target: DataFrame | None,
    column: str = "_loaded_at",
    full_refresh: bool = False,
) -> DataFrame:
    """Staged rows above the target's high-water mark; all of them if it has none.

    The mark is one value, read first and used as a literal, so it reaches the scan as
    a pushed filter.
    """
    if target is None or full_refresh:
        return staged
    mark = target.agg(F.unix_micros(F.max(column))).first()[0]
    return staged if mark is None else staged.where(F.col(column) > F.timestamp_micros(F.lit(mark)))


def merge_upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not updated, plus every update.

    `updates` must hold one row per key. New columns are appended.
    """
    untouched = target.join(updates.select(key), key, "left_anti")
    return append_evolving(untouched, updates)


@dataclass(frozen=True)
class StagedMerge:
    """New contents of the touched partitions, durable in the shared folder."""

    result: str
    touched: tuple


def stage_merge(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    partition: str,
    schema: StructType | None = None,
) -> StagedMerge:
    """Compute the touched partitions of a partitioned Parquet table after a merge.

    A touched partition is one that receives an update or holds the old version of an
    updated key; the others are neither read in full nor rewritten. Give the declared
    `schema` for a large table, else Spark opens every file footer to find columns that
    were appended later.
    """
    updates_path = scratch_path(spark, "merge-updates")
    updates.write.parquet(updates_path)
    fresh = spark.read.parquet(updates_path)
    if not duplicated(fresh, [key]).isEmpty():
        raise ValueError(f"updates hold several rows for one {key}")

    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    target = reader.parquet(path)
    moved = target.select(key, partition).join(fresh.select(key), key, "left_semi")
    # One row per calendar partition: a few hundred at most, however large the table.
    touched = {r[0] for r in fresh.select(partition).distinct().collect()}
    touched |= {r[0] for r in moved.select(partition).distinct().collect()}
    in_touched = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        in_touched = F.col(partition).isNull() | in_touched

    result = scratch_path(spark, "merge-result")
    merge_upsert(target.where(in_touched), fresh, key).write.parquet(result)
    drop_folder(spark, updates_path)
    return StagedMerge(result, tuple(touched))


def merged_view(spark: SparkSession, target: DataFrame, staged: StagedMerge, partition: str) -> DataFrame:
    """The table as it will be once the staged merge is published."""
    touched = [v for v in staged.touched if v is not None]
    replaced = F.col(partition).isin(touched)
    if None in staged.touched:
        replaced = F.col(partition).isNull() | replaced
    else:
        replaced = F.col(partition).isNotNull() & replaced
    return append_evolving(target.where(~replaced), spark.read.parquet(staged.result))


def publish_merge(
    spark: SparkSession, staged: StagedMerge, path: str, partition: str, cluster: Sequence[str] = ()
) -> int:
    """Replace the touched partitions by their staged contents; safe to repeat.

    The table is never overwritten from a plan that reads it, so a run that dies here is
    finished by calling this again. Partitions move into place one after another, so a
    high-water mark read from the rows may be past updates that have not arrived: keep the
    mark elsewhere, or use `sinks.versions`, where a merge is whole or absent.
    """
    result = spark.read.parquet(staged.result)
    filled = {r[0] for r in result.select(partition).distinct().collect()}
    # Dynamic overwrite leaves a partition alone that gets no rows any more.
    drop_partitions(spark, path, partition, set(staged.touched) - filled)
    return write_partitioned(result, path, partition, cluster) if filled else 0
