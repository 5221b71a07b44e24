"""Column tests: each names the rows or key groups that break a rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.operators.dedup import duplicated


@dataclass(frozen=True)
class Check:
    """A rule on rows (`breaks`) or on key combinations (`keys`)."""

    name: str
    breaks: Column | None = None
    keys: tuple[str, ...] = ()


def not_null(column: str) -> Check:
    return Check(f"not_null_{column}", F.col(column).isNull())


def unique(column: str) -> Check:
    return Check(f"unique_{column}", keys=(column,))


def unique_together(*columns: str) -> Check:
    return Check("unique_together_" + "_".join(columns), keys=columns)


def accepted(column: str, values: Sequence[str | None]) -> Check:
    """NULL passes, also as a member of the list, where it would let everything pass."""
    known = [v for v in values if v is not None]
    return Check(f"accepted_values_{column}", ~F.col(column).isin(known))


def within(column: str, low: object, high: object) -> Check:
    return Check(f"range_{column}", ~F.col(column).between(low, high))


def length_is(column: str, length: int) -> Check:
    return Check(f"length_{column}", F.length(column) != length)


def never(name: str, condition: Column) -> Check:
    return Check(name, condition)


def failing(rows: DataFrame, check: Check) -> DataFrame:
    """The rows that break the rule, or the repeated keys with their row count."""
    if check.breaks is not None:
        return rows.where(check.breaks)
    keyed = rows
    if len(check.keys) == 1:
        keyed = rows.where(F.col(check.keys[0]).isNotNull())
    return duplicated(keyed.select(*check.keys), check.keys)


def _key_counts(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """How often each key of each uniqueness rule occurs; a single column that is NULL is no key."""
    keys = []
    for i, check in enumerate(checks):
        text = F.to_json(F.struct(*check.keys), {"ignoreNullFields": "false"})
        entry = F.struct(F.lit(i).alias("_rule"), text.alias("_key"))
        keys.append(F.when(F.col(check.keys[0]).isNotNull(), entry) if len(check.keys) == 1 else entry)
    tagged = rows.select(F.inline(F.array_compact(F.array(*keys))))
    return tagged.groupBy("_rule", "_key").agg(F.count(F.lit(1)).alias("_n"))


def run_checks(rows: DataFrame, checks: Sequence[Check], model: str) -> DataFrame:
    """One result row per check: model, check_name, failures, status.

    All row rules of a table share one scan and one aggregate, all uniqueness rules another
    scan and one shuffle: every row gives its key once per rule, as text under the rule's
    number, and Spark counts them before the shuffle.
    """
    parts = []
    per_row = [c for c in checks if c.breaks is not None]
    per_key = [c for c in checks if c.breaks is None]
    if per_row:
        parts.append((per_row, rows.agg(*[F.count_if(c.breaks).alias(f"n{i}") for i, c in enumerate(per_row)])))
    if per_key:
        repeats = _key_counts(rows, per_key).where("_n > 1")
        counts = [F.count_if(F.col("_rule") == i).alias(f"n{i}") for i in range(len(per_key))]
        parts.append((per_key, repeats.agg(*counts)))
    summaries = [
        counts.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"n{i}").alias("failures")) for i, c in enumerate(named)
        ])))
        for named, counts in parts
    ]
    results = reduce(DataFrame.unionByName, summaries)
    return results.select(
        F.lit(model).alias("model"),
        "check_name",
        "failures",
        F.when(F.col("failures") > 0, "fail").otherwise("pass").alias("status"),
    )


class ChecksFailed(RuntimeError):
    """A stage may not continue."""


def require_passing(results: DataFrame) -> None:
    """Stop the stage if a check failed; only the failed summary rows are fetched."""
    failed = results.where(F.col("status") == "fail").collect()
    if failed:
        raise ChecksFailed("; ".join(
            ", ".join(f"{k}={v}" for k, v in row.asDict().items()) for row in failed
        ))
