"""Dates: archive hours, report windows and partition filters."""

from __future__ import annotations

import calendar
from collections import defaultdict
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Hour = tuple[date, int]

# Days of each report window, and the slider positions that select one.
WINDOW_DAYS = {"week": 7, "month": 30, "quarter": 90, "half_year": 180}
SLIDER_DAYS = {0: 7, 10: 30, 50: 90, 100: 180}


def as_date(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def window_days(window: str | int) -> int:
    """Length of a window given by name or as a number of days."""
    return WINDOW_DAYS[window] if isinstance(window, str) else int(window)


def window_start(as_of: date | str | Column, window: str | int) -> Column:
    """First day, inclusive, of the window that ends at ``as_of``."""
    return F.date_sub(as_date(as_of), window_days(window))


def slider_start(as_of: date | str | Column, position: int | None) -> Column:
    """Window start for a slider position; an unknown position means the day itself."""
    return window_start(as_of, SLIDER_DAYS.get(position, 0))


def utc_date(ts: Column) -> Column:
    """UTC date of a timestamp, whatever the session time zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def utc_hour(ts: Column) -> Column:
    return F.pmod(F.floor(F.unix_seconds(ts) / 3600), F.lit(24)).cast("int")


def month_bounds(year: str, month: str) -> tuple[date, date]:
    """First and last day of a month given as ``"2019"`` and ``"06"``."""
    if len(year) != 4 or not year.isdigit():
        raise ValueError("year must have four digits, such as 2019")
    if len(month) != 2 or not month.isdigit() or not 1 <= int(month) <= 12:
        raise ValueError("month must have two digits between 01 and 12")
    last = calendar.monthrange(int(year), int(month))[1]
    return date(int(year), int(month), 1), date(int(year), int(month), last)


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def months_between(first: date, last: date) -> list[str]:
    """``YYYY-MM`` of every month touched by the days ``first`` to ``last``."""
    return [f"{month[0]:%Y-%m}" for month in by_month(days_between(first, last))]


def by_month(days: Iterable[date]) -> list[list[date]]:
    """Days grouped by month, in order."""
    months = defaultdict(list)
    for day in sorted(set(days)):
        months[day.year, day.month].append(day)
    return list(months.values())


def days_scope(days: Iterable[date]) -> Column:
    """Partition filter for whole days."""
    return F.col("create_date").isin(sorted(set(days)))


def hours_scope(hours: Iterable[Hour]) -> Column:
    """Partition filter for hours; days with the same hours share one term."""
    by_day = defaultdict(set)
    for day, hour in hours:
        by_day[day].add(hour)
    by_hours = defaultdict(list)
    for day, day_hours in by_day.items():
        by_hours[tuple(sorted(day_hours))].append(day)
    scope = F.lit(False)
    for day_hours, days in sorted(by_hours.items()):
        scope = scope | (days_scope(days) & F.col("hour").isin(list(day_hours)))
    return scope
