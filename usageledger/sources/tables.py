"""Warehouse tables and databases."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_day(text: str | date) -> date:
    """A strict YYYY-MM-DD day."""
    if isinstance(text, date):
        return text
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError:
        raise ValueError(f"not a YYYY-MM-DD day: {text!r}") from None


def day_range(first: str | date, last: str | date) -> tuple[date, date]:
    start, end = parse_day(first), parse_day(last)
    if start > end:
        raise ValueError(f"range starts {start}, after its end {end}")
    return start, end


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """A raw event table, whether foldered by `load_date` or by year, month, day and hour.

    The latter gets its `load_date` from the folder names alone, so a filter on it is
    answered without opening the files of other days.
    """
    events = spark.read.parquet(path)
    if "load_date" not in events.columns and {"year", "month", "day"} <= set(events.columns):
        events = events.withColumn("load_date", F.make_date("year", "month", "day"))
    return events


def loaded_between(
    rows: DataFrame,
    first: str | date,
    last: str | date,
    column: str = "_loaded_at",
    partition: str = "load_date",
) -> DataFrame:
    """Rows loaded on `first`..`last`, both included.

    The bounds are compared with the bare column so they reach the Parquet scan, and
    with the physical `load_date` column too where the table has one, so directories
    are pruned.
    """
    start, end = day_range(first, last)
    stamp = F.col(column)
    wanted = (stamp >= F.lit(start).cast("timestamp")) & (
        stamp < F.lit(end + timedelta(days=1)).cast("timestamp")
    )
    if partition in rows.columns:
        wanted &= F.col(partition).between(F.lit(start), F.lit(end))
    return rows.where(wanted)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read over `partitions` parallel connections."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, **options)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
