"""Date and time helpers whose results do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

TS_MIN = dt.datetime(1, 1, 1)
TS_MAX = dt.datetime(9999, 12, 31, 23, 59, 59)


def ts_literal(value: dt.datetime | dt.date) -> Column:
    """A wall-clock timestamp literal."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_literal(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def ts_min() -> Column:
    return ts_literal(TS_MIN)


def ts_max() -> Column:
    return ts_literal(TS_MAX)


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "MM")


def week_start(d: Column | str) -> Column:
    """Monday of the ISO week."""
    return F.trunc(_col(d), "week")


def day_of_week(d: Column | str) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(_col(d)) - 1


def is_weekend(d: Column | str) -> Column:
    return F.coalesce(day_of_week(d).isin(0, 6), F.lit(False))


def add_years(d: Column | str, years: int) -> Column:
    return F.add_months(_col(d), 12 * years)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(_col(end), _col(start))


def singapore_to_utc(ts: Column | str) -> Column:
    """Wall-clock time at +08:00 as wall-clock time in UTC."""
    return F.convert_timezone(F.lit("+08:00"), F.lit("UTC"), _col(ts))


def scraped_on(day: Column | str) -> Column:
    """Scrape time of a snapshot from its partition day; the earliest timestamp when unknown."""
    return F.coalesce(_col(day).cast("timestamp_ntz"), ts_min())


def presumed_deleted(scraped: Column | str, as_of: dt.date, after_days: int = 2) -> Column:
    """True for entities that newer full snapshots no longer report."""
    return days_between(scraped, date_literal(as_of)) > after_days


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
