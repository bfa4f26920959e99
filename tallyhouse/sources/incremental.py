"""Incremental loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.dates import date_literal
from tallyhouse.operators.dedupe import latest_per_key


def high_water_mark(landed: DataFrame, column: str) -> int | None:
    """Largest mark landed so far; None when nothing has landed."""
    return landed.agg(F.max(column)).first()[0]


def newer_than(snapshots: DataFrame, column: str, landed: DataFrame) -> DataFrame:
    """Snapshots beyond the landed mark, or all of them when nothing has landed.

    A snapshot without a mark can't be told to be old, so it counts as new. The mark is one
    number, so it becomes a literal that the scan can push down.
    """
    mark = high_water_mark(landed, column)
    return snapshots if mark is None else snapshots.filter((F.col(column) > mark) | F.col(column).isNull())


def late_window(df: DataFrame, column: str, start: dt.date, days: int = 3) -> DataFrame:
    """Rows of ``start`` and the ``days`` after it; negative ``days`` look back."""
    first, last = sorted((start, start + dt.timedelta(days=days)))
    day_after = last + dt.timedelta(days=1)
    # half-open bounds on the bare column, so that they reach the scan
    return df.filter((F.col(column) >= date_literal(first)) & (F.col(column) < date_literal(day_after)))


def merge_days(
    current: DataFrame, arrived: DataFrame, keys: list[str], day: str, version: str, ties: list[str]
) -> DataFrame:
    """Newest-wins content of the days that ``arrived`` touches, ready for a dynamic partition
    overwrite. ``day`` must be fixed per key, so other days cannot change."""
    touched = arrived.select(day).distinct()
    affected = current.join(touched, day, "left_semi")
    return latest_per_key(affected.unionByName(arrived), keys, version, ties).select(current.columns)
