"""Versioned dimensions: one row per key and validity period."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usageledger.functions.columns import moment, version_key
from usageledger.operators.dedup import keep_latest
from usageledger.operators.lookup import hot_keys

PERIOD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def current_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col("dbt_valid_to").isNull())


def _opened(key: str | Column, updated_at: str | Column) -> dict[str, Column]:
    stamp = F.col(updated_at) if isinstance(updated_at, str) else updated_at
    return {
        "dbt_scd_id": version_key(key, stamp),
        "dbt_updated_at": stamp,
        "dbt_valid_from": stamp,
        "dbt_valid_to": F.lit(None).cast("timestamp"),
    }


def open_history(source: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """The first snapshot: every source row is current."""
    return source.withColumns(_opened(key, updated_at))


def snapshot_moves(
    current: DataFrame,
    source: DataFrame,
    key: str,
    as_of: datetime | Column,
    updated_at: str = "updated_at",
    close_missing: bool = True,
) -> DataFrame:
    """What the current versions become after a new extract of their source.

    A key seen for the first time, or again after it was closed, opens a version. A
    later `updated_at` closes the current version at that moment and opens the next. A
    key the extract lacks is closed at `as_of`. Anything else stays. Columns that only
    one side has are kept and NULL on the other. Both sides hold one row per key.
    """
    kinds = {f.name: f.dataType for f in source.schema.fields}
    kinds.update({f.name: f.dataType for f in current.schema.fields})
    names = [c for c in kinds if c not in PERIOD_COLUMNS] + PERIOD_COLUMNS

    def as_row(side: str, present: list[str], replaced: dict[str, Column]) -> Column:
        return F.struct(*[
            replaced.get(
                c,
                F.col(f"{side}.{c}") if c in present else F.lit(None),
            ).cast(kinds[c]).alias(c)
            for c in names
        ])

    held = current.select(F.struct("*").alias("held"))
    seen = source.select(F.struct("*").alias("seen"))
    paired = held.join(seen, F.col(f"held.{key}") == F.col(f"seen.{key}"), "full_outer")

    keep = as_row("held", current.columns, {})
    opened = as_row(
        "seen", source.columns, _opened(F.col(f"seen.{key}"), F.col(f"seen.{updated_at}"))
    )
    replaced = as_row("held", current.columns, {"dbt_valid_to": F.col(f"seen.{updated_at}")})
    ended = as_row("held", current.columns, {"dbt_valid_to": moment(as_of)}) if close_missing else keep
    is_newer = F.col("held.dbt_valid_from") < F.col(f"seen.{updated_at}")
    versions = (
        F.when(F.col("held").isNull(), F.array(opened))
        .when(F.col("seen").isNull(), F.array(ended))
        .when(is_newer, F.array(replaced, opened))
        .otherwise(F.array(keep))
    )
    return paired.select(F.inline(versions))


def apply_snapshot(
    history: DataFrame,
    source: DataFrame,
    key: str,
    as_of: datetime | Column,
    updated_at: str = "updated_at",
    close_missing: bool = True,
) -> DataFrame:
    """A whole history after a new extract; closed versions pass without entering the join."""
    moves = snapshot_moves(
        current_versions(history), source, key, as_of, updated_at, close_missing
    )
    closed = history.where(F.col("dbt_valid_to").isNotNull())
    return moves.unionByName(closed, allowMissingColumns=True)


def history_from_log(
    log: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Build the whole history from a change log at once.

    Equal to applying the log's states one after another when nothing is deleted. Each
    version ends where the next of its key begins. For a hot key (see
    `lookup.hot_keys`, used unless a list is given) that successor is looked up inside
    one second of the key; the last version of a second ends where the key's next busy
    second of that hour begins, and the last of an hour where its next busy hour begins.
    Times are unique per key by then and have microseconds, so no window holds more than
    a million versions, 3,600 seconds, or the hours of the key's life.
    """
    if hot is None:
        hot = hot_keys(log.select(key), key)
    marks = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    bucketed = (
        log.join(marks, key, "left")
        .withColumn("_second", F.when(F.col("_hot"), F.date_trunc("second", updated_at)))
        .drop("_hot")
    )
    states = keep_latest(bucketed, [key, "_second", updated_at], [])
    inside = Window.partitionBy(key, "_second").orderBy(updated_at)
    linked = states.withColumn("_next", F.lead(updated_at).over(inside))

    hour = F.date_trunc("hour", "_second").alias("_hour")
    seconds = (
        bucketed.where(F.col("_second").isNotNull())
        .groupBy(key, hour, "_second")
        .agg(F.min(updated_at).alias("_first"))
    )
    hours = seconds.groupBy(key, "_hour").agg(F.min("_first").alias("_first"))
    next_hour = F.lead("_first").over(Window.partitionBy(key).orderBy("_hour")).alias("_next_hour")
    next_second = F.lead("_first").over(Window.partitionBy(key, "_hour").orderBy("_second")).alias("_next_second")
    following = (
        seconds.select(key, "_hour", "_second", next_second)
        .join(hours.select(key, "_hour", next_hour), [key, "_hour"])
        .select(key, "_second", F.coalesce("_next_second", "_next_hour").alias("_following"))
    )
    period = _opened(key, updated_at)
    period["dbt_valid_to"] = F.coalesce("_next", "_following")
    return (
        linked.join(following, [key, "_second"], "left")
        .withColumns(period)
        .drop("_second", "_next", "_following")
    )
