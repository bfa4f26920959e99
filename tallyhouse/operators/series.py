"""Window calculations over series that are already aggregated to one row per period.

The aggregation bounds the rows per series by the number of periods, so an
unpartitioned window here sorts thousands of rows, whatever the size of the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tallyhouse.functions.money import MONEY_SUM


def _series(order: str, by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_last())


def running_total(value: str, order: str, by: Sequence[str] = ()) -> Column:
    window = _series(order, by).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(window).cast(MONEY_SUM)


def rolling_mean(value: str, order: str, points: int, by: Sequence[str] = (), digits: int = 4) -> Column:
    """Mean of the last ``points`` rows present; the first rows average what there is."""
    window = _series(order, by).rowsBetween(1 - points, 0)
    total, n = F.sum(value).over(window), F.count(value).over(window)
    return F.round(F.try_divide(total.cast("double"), n.cast("double")), digits)


def change_from_previous(
    value: str, order: str, lag: int = 1, by: Sequence[str] = (), digits: int = 6
) -> Column:
    """Relative change against the row ``lag`` periods earlier; NULL without one or when it is zero."""
    before = F.lag(value, lag).over(_series(order, by))
    step = (F.col(value) - before).cast("double")
    return F.round(F.try_divide(step, F.abs(before).cast("double")), digits)


def latest_period(series: DataFrame, order: str, by: Sequence[str] = ()) -> DataFrame:
    """The newest row of each series, as one aggregation."""
    rest = [c for c in series.columns if c not in (order, *by)]
    picked = [F.max_by(c, order).alias(c) for c in rest]
    return series.groupBy(*by).agg(F.max(order).alias(order), *picked)


def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest metric: per-task heaps, then one merge."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ties)).limit(k)
