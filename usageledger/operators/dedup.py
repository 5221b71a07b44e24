"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(rows: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the greatest `newest` values per key.

    Remaining columns settle ties, so the result does not depend on task order. Pass
    only the columns you need: every column takes part. Spark trims each map task to
    one row per key before the shuffle (WindowGroupLimit), so a key holding a large
    share of the table still sends few rows to its reducer.
    """
    settled = [*keys, *newest]
    order = [F.col(c).desc_nulls_last() for c in newest]
    order += [F.col(c).desc_nulls_last() for c in rows.columns if c not in settled]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def duplicated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")
