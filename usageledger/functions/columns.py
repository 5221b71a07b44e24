"""Scalar expressions: text cleaning, money, epochs, calendar, keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from usageledger import fixed_values as fv

MONEY = "decimal(18,6)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def moment(value: datetime | Column | None = None) -> Column:
    """A point in time: now, a column, or a datetime, which without a zone means UTC."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def tidy(value: Column | str, upper: bool = False, any_whitespace: bool = False) -> Column:
    """Strip the ends and fold case; `any_whitespace` also strips tabs and newlines."""
    text = _col(value)
    if any_whitespace:
        text = F.regexp_replace(text, r"^\s+|\s+$", "")
    else:
        text = F.trim(text)
    return F.upper(text) if upper else F.lower(text)


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def cents_to_units(value: Column | str) -> Column:
    """Unparsable or oversized cents become NULL. The narrow decimal keeps later products exact."""
    cents = _col(value).try_cast("decimal(18,4)")
    return (cents / F.lit(100)).try_cast(MONEY)


def annualised(monthly: Column | str) -> Column:
    """Twelve months; an amount too large for its type becomes NULL instead of ending the job."""
    return (_col(monthly) * F.lit(fv.MONTHS_PER_YEAR)).try_cast(MONEY)


def seconds_to_timestamp(value: Column | str, zero_means_unset: bool = True) -> Column:
    seconds = _col(value).try_cast("bigint")
    if zero_means_unset:
        seconds = F.nullif(seconds, F.lit(0).cast("bigint"))
    return F.timestamp_seconds(seconds)


def millis_to_date(value: Column | str) -> Column:
    return F.to_date(F.timestamp_millis(_col(value)))


def whole_units_between(unit: str, earlier: Column | str, later: Column | str) -> Column:
    """Complete units elapsed, unlike `datediff`, which counts midnights crossed."""
    return F.timestamp_diff(unit, _col(earlier), _col(later))


def strict_day(value: Column | str) -> Column:
    """The day that a YYYY-MM-DD text names; NULL for any other form and for days that do not exist."""
    text = _col(value)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def month_of(value: Column | str) -> Column:
    return F.trunc(F.to_date(_col(value)), "month")


def relative_gap(measured: Column | str, expected: Column | str) -> Column:
    """|measured - expected| / expected, NULL when there is nothing to divide by."""
    return F.try_divide(F.abs(_col(measured) - _col(expected)), _col(expected))


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the text of the columns; a NULL has its own text, so it is not ''."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(fv.NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws(fv.KEY_SEPARATOR, *parts))


def version_key(key: Column | str, updated_at: Column | str) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in (key, updated_at)]
    return F.md5(F.concat_ws(fv.VERSION_SEPARATOR, *parts))


def last_segment(value: Column | str, separator: str = ".") -> Column:
    """Text after the last separator; the whole text if there is none."""
    return F.substring_index(_col(value), separator, -1)


def labelled(value: Column | str, labels: Mapping[str, str], otherwise: str) -> Column:
    """Translate exact values; anything else, NULL included, gets `otherwise`."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, _col(value)), F.lit(otherwise))


def banded(
    value: Column, floors: Iterable[tuple[int, str]], otherwise: Column | str | None
) -> Column:
    """The label of the first floor the value reaches; floors go from high to low."""
    rest = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    for floor, label in reversed(list(floors)):
        rest = F.when(value >= F.lit(floor), F.lit(label)).otherwise(rest)
    return rest


def capped(value: Column, ceilings: Iterable[tuple[int, str]], otherwise: str) -> Column:
    """The label of the first ceiling the value does not exceed, from low to high."""
    rest = F.lit(otherwise)
    for ceiling, label in reversed(list(ceilings)):
        rest = F.when(value <= F.lit(ceiling), F.lit(label)).otherwise(rest)
    return rest


def hour_parts(value: Column | str) -> dict[str, Column]:
    """Zero-padded directory parts of a timestamp."""
    stamp = _col(value)
    return {
        "year": F.date_format(stamp, "yyyy"),
        "month": F.date_format(stamp, "MM"),
        "day": F.date_format(stamp, "dd"),
        "hour": F.date_format(stamp, "HH"),
    }


def hour_path(value: Column | str, prefix: str) -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.date_format(_col(value), "yyyy/MM/dd/HH"))
