"""Calendar generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.dates import day_of_week, is_weekend, month_start, week_start


def day_spine(bounds: DataFrame, start: Column, end: Column, name: str = "date_day") -> DataFrame:
    """One row per day from ``start`` up to but excluding ``end``, for the row(s) of ``bounds``."""
    last = F.date_sub(end, 1)
    days = F.when(start <= last, F.sequence(start, last, F.expr("interval 1 day")))
    return bounds.select(F.explode(days).alias(name))


def calendar(days: DataFrame, updated_at: Column, day: str = "date_day") -> DataFrame:
    """Calendar attributes of each day."""
    d = F.col(day)
    return days.select(
        d.alias("id"),
        d.alias("date"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        week_start(d).alias("year_month_week"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        F.date_format(d, "EEE").alias("weekday_short"),
        F.month(d).alias("month_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.year(d).alias("year"),
        month_start(d).alias("year_month"),
        is_weekend(d).alias("is_weekend"),
        updated_at.alias("updated_at"),
    )
