"""Date ranges, always computed from an explicit reference date.

Every range is turned into a half-open comparison on the raw time column, so it
reaches the parquet scan and prunes row groups and date partitions. Wrapping the
column in a function (``month(ts) = 5``) would not.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = dt.timedelta(days=1)


def to_day(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def shift_months(day: dt.date, months: int) -> dt.date:
    """The same day some months away, or the last day of a shorter month."""
    year, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def full_months(as_of: dt.date | str, months: int) -> tuple[dt.date, dt.date]:
    """The last ``months`` complete months before ``as_of``, end exclusive."""
    end = month_start(to_day(as_of))
    return shift_months(end, -months), end


def within(column: str | Column, start: dt.date, end: dt.date) -> Column:
    """``start <= column < end``."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(start)) & (column < F.lit(end))


def last_days(column: str, as_of: dt.date | str, first_age: int, last_age: int = 0) -> Column:
    """Rows whose age in days at ``as_of`` lies between the two ages, inclusive."""
    day = to_day(as_of)
    return within(column, day - first_age * DAY, day - last_age * DAY + DAY)


def in_months(column: str, months: list[int] | None, year: int | None) -> Column:
    """Calendar months as ranges; without a year only ``month()`` can tell."""
    if months is None and year is None:
        return F.lit(True)
    if year is None:
        return F.month(column).isin(list(months))
    wanted = sorted(set(months)) if months is not None else list(range(1, 13))
    ranges: list[list[dt.date]] = []
    for month in wanted:
        first = dt.date(year, month, 1)
        if ranges and ranges[-1][1] == first:
            ranges[-1][1] = shift_months(first, 1)
        else:
            ranges.append([first, shift_months(first, 1)])
    condition = F.lit(False)
    for first, end in ranges:
        condition = condition | within(column, first, end)
    return condition


def months_between(
    months: list[int], first: dt.date | None, last: dt.date | None
) -> Callable[..., Column]:
    """Calendar months of every year from ``first`` to ``last`` (dates or times, inclusive).

    Returns a function of a column name, and of a margin by which each range is widened.
    Every range reaches the scan; nothing lies within when there is no first time.
    """
    years = range(first.year, last.year + 1) if first is not None else ()
    starts = [dt.date(year, month, 1) for year in years for month in sorted(set(months))]

    def condition(column: str, margin: dt.timedelta = dt.timedelta(0)) -> Column:
        found = F.lit(False)
        for start in starts:
            found = found | within(column, start - margin, shift_months(start, 1) + margin)
        return found

    return condition


def month_of(column: str) -> Column:
    """First day of the month, as a date (independent of the session time zone)."""
    return F.trunc(F.to_date(column), "month")


def month_label(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MMM")


def month_labels(start: dt.date | str, end: dt.date | str) -> list[str]:
    """Labels of every month touched by ``start <= day < end``."""
    month, end, labels = month_start(to_day(start)), to_day(end), []
    while month < end:
        labels.append(f"{month.year}-{calendar.month_abbr[month.month]}")
        month = shift_months(month, 1)
    return labels


def short_month(label: str) -> str:
    """``2024-Aug`` -> ``aug_24``, the column name used in wide reports."""
    year, month = label.split("-")
    return f"{month.lower()}_{year[2:]}"


def moment(value: dt.datetime) -> Column:
    """A zone-less timestamp literal. (A plain datetime literal would be an instant and
    would shift with the session time zone.)"""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _epoch() -> Column:
    return moment(dt.datetime(1970, 1, 1))


def second_number(column: str) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp (fractions cut off)."""
    return F.timestamp_diff("SECOND", _epoch(), F.col(column))


def as_utc(column: str) -> Column:
    """A zone-less timestamp as the instant it names in UTC, whatever the session zone.

    Watermarks need instants; their windows are aligned in UTC.
    """
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), F.col(column)))


def from_utc(column: str) -> Column:
    """The zone-less UTC time of an instant, the reverse of ``as_utc``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(column), _epoch())
