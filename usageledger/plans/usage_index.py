"""Daily usage metrics whose cost follows the load, not the history.

Beside the metrics a state is kept, as tables that change by version:

- `index`, one row per event id with the event day of its newest copy, cut by a hash of the id;
- `latest`, the newest copy of every event, foldered by event day;
- `members`, the distinct users and sessions of every metrics row, foldered by event day;
- `daily`, the metrics.

A load reads its own load days of the raw table, asks the index for the ids it brings, and touches
only the days that the index and the load name. Days that only gain events are brought forward: counts
are added, and a distinct count grows by the values that `members` does not hold yet, so no old event is
read. Days that an event left, or in which one was replaced, are computed again from `latest`. One
list names the versions of all four tables and is published last, so a load is whole or absent, and
one that stopped is done again. Loads may come in any order and more than once.

Distinct values are rows, not bitmaps: a metrics row has a user or two on most days, and a bitmap
takes 4 KiB whatever it holds.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usageledger import fixed_values as fv
from usageledger.functions.columns import millis_to_date
from usageledger.plans.usage import CLUSTER, GRAIN, MEASURED, POSITION, clean_events, daily_metrics, latest_events
from usageledger.session import pin_utc, scratch_path
from usageledger.sinks import versions
from usageledger.sinks.files import drop_folder
from usageledger.sources.tables import loaded_between, parse_day, read_events

DAY = "event_date"
BUCKET = "id_bucket"
# So many folders of the index, by a hash of the id.
BUCKETS = 8
MEMBERS = ["unique_users", "unique_sessions"]
# The list of the tables' versions that belong together.
STATE = "_state"
TABLES = {"index": BUCKET, "latest": DAY, "members": DAY, "daily": DAY}
METRICS = ["event_count", *MEMBERS, "first_event_ts", "last_event_ts"]


def _in_days(days: Iterable[date | None], column: str = DAY) -> Column:
    """Whether a row is of one of these days; None is the day of events without a time."""
    known = [F.lit(d) for d in days if d is not None]
    found = F.col(column).isin(*known) if known else F.lit(False)
    found = F.coalesce(found, F.lit(False))
    return F.col(column).isNull() | found if None in set(days) else found


def _days(rows: DataFrame, column: str = DAY) -> set:
    """One value per calendar day."""
    return {r[0] for r in rows.select(column).distinct().collect()}


def _stored(rows: DataFrame, label: str, dropped: list[str]) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    dropped.append(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def member_rows(cleaned: DataFrame) -> DataFrame:
    """The distinct users and sessions of every metrics row."""
    values = F.array(*[F.struct(F.lit(m).alias("kind"), F.col(c).alias("value")) for m, c in zip(MEMBERS, ("user_id", "session_id"), strict=True)])
    return cleaned.select(*GRAIN, F.inline(values)).where(F.col("value").isNotNull()).distinct()


def new_members(members: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The users and sessions of cleaned events that their metrics rows do not hold yet."""
    both = members.select(*GRAIN, "kind", "value", F.lit(True).alias("known"))
    both = both.unionByName(member_rows(cleaned).withColumn("known", F.lit(False)))
    return both.groupBy(*GRAIN, "kind", "value").agg(F.bool_or("known").alias("known")).where(~F.col("known")).drop("known")


def brought_forward(daily: DataFrame, fresh: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The metrics after cleaned events that no metrics row counts yet have come, with their new members."""
    more = fresh.groupBy(*GRAIN).agg(*[F.count_if(F.col("kind") == m).alias(m) for m in MEMBERS])
    counted = cleaned.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("event_count"), F.min("event_timestamp").alias("first_event_ts"), F.max("event_timestamp").alias("last_event_ts")
    )
    parts = daily.select(*GRAIN, *METRICS).unionByName(counted, allowMissingColumns=True).unionByName(more, allowMissingColumns=True)
    return parts.groupBy(*GRAIN).agg(
        F.sum("event_count").alias("event_count"),
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEMBERS],
        F.min("first_event_ts").alias("first_event_ts"),
        F.max("last_event_ts").alias("last_event_ts"),
    )


def _state(spark: SparkSession, state: str) -> dict[str, versions.Version]:
    """The versions of the tables that belong together."""
    held = versions.version(spark, f"{state}/{STATE}")
    numbers = held.mark or {}
    return {name: versions.version(spark, f"{state}/{name}", numbers.get(name, 0)) if name in numbers else versions.Version() for name in TABLES}


def read_state(spark: SparkSession, state: str, name: str = "daily") -> DataFrame | None:
    """A table of the state as of its last whole load."""
    return versions.read(spark, f"{state}/{name}", _state(spark, state)[name])


def arriving(events: DataFrame, first: str | date, last: str | date) -> DataFrame:
    """The newest copy of each event among those loaded from `first` to `last`."""
    loaded = loaded_between(events, first, last)
    position = [c for c in POSITION if c in loaded.columns]
    rows = latest_events(loaded.select(*MEASURED, *position))
    return rows.withColumns({DAY: millis_to_date("event_timestamp"), BUCKET: F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int")})


def load_days(spark: SparkSession, raw_path: str, state: str, first: str | date, last: str | date | None = None) -> dict[str, int]:
    """Bring the metrics forward by what was loaded from `first` to `last`.

    Returns how many events were added or replaced and how many days were brought forward
    or computed again.
    """
    pin_utc(spark)
    start = parse_day(first)
    end = parse_day(last) if last else start
    base, scratch = _state(spark, state), []
    path = {name: f"{state}/{name}" for name in TABLES}
    came = _stored(arriving(read_events(spark, raw_path), start, end), "usage-arrived", scratch)

    known = versions.read(spark, path["index"], base["index"])
    if known is None:
        won, replaced, old = came, came.limit(0).select("event_id", DAY), {}
    else:
        mine = known.select("event_id", DAY, BUCKET, versions.file_path())
        mine = mine.join(came.select("event_id", BUCKET), [BUCKET, "event_id"], "left_semi").drop(BUCKET)
        mine = _stored(mine, "usage-known", scratch)
        held = versions.read(spark, path["latest"], base["latest"]).select("*", versions.file_path())
        held = _stored(versions.meet(held.where(_in_days(_days(mine))), mine, "event_id", "left_semi"), "usage-held", scratch)
        # The same order decides between the held copy and the arriving one as within a load;
        # of copies that are equal in everything the held one stays. Only ids that both have take part.
        rivals = versions.meet(came, mine, "event_id", "left_semi").withColumn("_held", F.lit(0))
        rivals = rivals.unionByName(held.drop(versions.FILE).withColumn("_held", F.lit(1)), allowMissingColumns=True)
        lost = _stored(latest_events(rivals).where("_held = 1").select("event_id"), "usage-lost", scratch)
        won = versions.meet(came, lost, "event_id", "left_anti")
        if not versions.few(lost):
            won = _stored(won, "usage-won", scratch)
        replaced = _stored(versions.meet(mine, lost, "event_id", "left_anti"), "usage-replaced", scratch)
        # Where the replaced copies lie, so that neither table is searched again.
        old = {"index": replaced, "latest": _stored(versions.meet(held.select("event_id", versions.FILE), replaced, "event_id", "left_semi"), "usage-old", scratch)}
    left = _days(replaced)
    again = left | _days(versions.meet(won.select("event_id", DAY), replaced, "event_id", "left_semi"))
    days = _days(won)
    forward = days - again
    if not days:
        for folder in scratch:
            drop_folder(spark, folder)
        return {"events": 0, "days_forward": 0, "days_again": 0}

    # Files of the two tables by event that hold a replaced event are the only ones rewritten.
    files, schemas = {}, {}
    for name, rows in (("index", won.select("event_id", DAY, BUCKET)), ("latest", won)):
        merge = versions.stage_merge(spark, path[name], base[name], rows, "event_id", stored=True, old=old.get(name))
        files[name] = versions.place_merge(spark, path[name], merge, TABLES[name], ["event_id"] if name == "index" else CLUSTER)
        schemas[name] = merge.schema
        drop_folder(spark, merge.result)

    added = clean_events(won.where(_in_days(forward)))
    daily, members = (versions.read(spark, path[n], base[n]) for n in ("daily", "members"))
    if daily is None:
        daily = daily_metrics(clean_events(won)).limit(0)
        members = member_rows(clean_events(won)).limit(0)
    fresh = new_members(members.where(_in_days(forward)), added)
    if again:
        latest = versions.read(spark, path["latest"], versions.Version(0, tuple(files["latest"]), schemas["latest"].json()))
        whole = clean_events(latest.where(_in_days(again)))
        fresh = fresh.unionByName(member_rows(whole))
        added = added.unionByName(whole.select(*added.columns))

    def replace_days(name: str, rows: DataFrame, gone: set) -> list[str]:
        out = set(versions.in_partitions(base[name], DAY, gone))
        written = versions.add_files(rows, path[name], DAY, CLUSTER)
        files[name] = [*(f for f in base[name].files if f not in out), *written]
        schemas[name] = rows.schema
        return written

    # Distinct values are found once; the metrics count them as they were written.
    written = replace_days("members", fresh, again)
    fresh = versions.read(spark, path["members"], versions.Version(0, tuple(written), fresh.schema.json()))
    replace_days("daily", brought_forward(daily.where(_in_days(forward)), fresh, added), again | forward)

    _publish(spark, state, base, files, schemas)
    count = won.count()
    for folder in scratch:
        drop_folder(spark, folder)
    return {"events": count, "days_forward": len(forward), "days_again": len(again)}


def _publish(spark: SparkSession, state: str, base: dict[str, versions.Version], files: dict[str, list[str]], schemas: dict[str, StructType]) -> None:
    """New versions of all tables, which count once the list over them is published."""
    together = f"{state}/{STATE}"
    before = versions.version(spark, together)
    made = {name: versions.publish(spark, f"{state}/{name}", files[name], schemas[name]).number for name in TABLES}
    versions.publish(spark, together, [], StructType(), made, after=before.number)
    for name in TABLES:
        versions.delete_files(spark, f"{state}/{name}", set(base[name].files) - set(files[name]))


def clean_state(spark: SparkSession, state: str) -> int:
    """Delete what loads that stopped have left, and the lists of older versions; no load may be running."""
    held = _state(spark, state)
    versions.clean(spark, f"{state}/{STATE}")
    return sum(versions.clean(spark, f"{state}/{name}", [held[name].number]) for name in TABLES)


def usage_metrics(spark: SparkSession, state: str) -> DataFrame | None:
    """The metrics as of the last whole load."""
    daily = read_state(spark, state)
    return None if daily is None else daily.withColumn("_source", F.lit(fv.BATCH_SOURCE))
