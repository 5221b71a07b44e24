"""Expiry of old partitions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger import fixed_values as fv
from usageledger.sinks.files import NO_VALUE, drop_partitions, partition_folders


def unexpired(rows: DataFrame, as_of: date, days: int = fv.RAW_RETENTION_DAYS, partition: str = "load_date") -> DataFrame:
    """Rows whose partition day is within `days` of `as_of`; rows without a day stay."""
    day = F.col(partition)
    return rows.where(day.isNull() | (day >= F.lit(as_of - timedelta(days=days))))


def expired_days(rows: DataFrame, as_of: date, days: int = fv.RAW_RETENTION_DAYS, partition: str = "load_date") -> DataFrame:
    """The partitions to drop. Only the partition column is read."""
    return (
        rows.where(F.col(partition) < F.lit(as_of - timedelta(days=days)))
        .select(partition)
        .distinct()
    )


def expire_path(spark: SparkSession, path: str, as_of: date, days: int = fv.RAW_RETENTION_DAYS, partition: str = "load_date") -> list[date]:
    """Drop the expired partitions of a Parquet table; its folder names say which, no data is read."""
    oldest = as_of - timedelta(days=days)
    named = [v for v in partition_folders(spark, path, partition) if v != NO_VALUE]
    gone = [day for day in map(date.fromisoformat, named) if day < oldest]
    drop_partitions(spark, path, partition, gone)
    return gone
