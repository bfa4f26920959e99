"""Dashboard metrics: declarative definitions and the one function that runs them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.dates import date_literal, month_start
from tallyhouse.functions.money import MONEY, MONEY_SUM, money_sum, ratio
from tallyhouse.operators.series import (
    change_from_previous,
    latest_period,
    rolling_mean,
    running_total,
    top_k,
)

# calendar grains of dates: they do not pass through an instant, so no time zone is involved
GRAINS: dict[str, Callable[[str], Column]] = {"P1D": F.to_date, "P1M": month_start}


@dataclass(frozen=True)
class MetricSpec:
    """A time-series, grouped or single-number metric over a mart."""

    source: str
    reads: tuple[str, ...]  # mart columns the metric needs
    value: Callable[[], Column]
    time_column: str | None = None
    grain: str | None = None  # one of GRAINS
    time_range: str | tuple[dt.date, dt.date] | None = None  # 'last month', 'last year' or [from, to)
    only_if: str | None = None  # boolean column that must be true
    group_by: tuple[str, ...] = ()
    cumulative: bool = False
    rolling: int | None = None
    compare_lag: int | None = None
    target: int | None = None  # adds progress towards it
    headline: bool = False  # newest period only
    row_limit: int | None = None  # the newest periods, or the largest values
    sort_by_value: bool = False


def time_bounds(spec: MetricSpec, as_of: dt.date) -> tuple[Column, Column] | None:
    """Half-open bounds of the metric's time range, seen from ``as_of``."""
    today = date_literal(as_of)
    match spec.time_range:
        case None:
            return None
        case "last month":
            return F.add_months(today, -1), today
        case "last year":
            return F.add_months(today, -12), today
        case (start, end):
            return date_literal(start), date_literal(end)
        case other:
            raise ValueError(f"unknown time range {other!r}")


def run_metric(spec: MetricSpec, mart: DataFrame, as_of: dt.date) -> DataFrame:
    """The metric as rows ``(period, *group_by, value, ...)``.

    Filters sit on bare mart columns, so they reach the scan of a stored mart. The facts
    are shuffled once, as partial sums; all later steps work on one row per period and group.
    """
    df = mart
    if spec.only_if:
        df = df.filter(F.col(spec.only_if))
    bounds = time_bounds(spec, as_of)
    if bounds:
        df = df.filter((F.col(spec.time_column) >= bounds[0]) & (F.col(spec.time_column) < bounds[1]))
    keys = [F.col(c) for c in spec.group_by]
    if spec.grain:
        keys = [GRAINS[spec.grain](spec.time_column).alias("period"), *keys]
    out = df.groupBy(*keys).agg(spec.value().alias("value")) if keys else df.agg(spec.value().alias("value"))
    by = spec.group_by
    if spec.cumulative:
        out = out.withColumn("value", running_total("value", "period", by))
    if spec.compare_lag:
        out = out.withColumn("change", change_from_previous("value", "period", spec.compare_lag, by))
    if spec.rolling:
        out = out.withColumn("value", rolling_mean("value", "period", spec.rolling, by))
    if spec.headline:
        out = latest_period(out, "period", by)
    if spec.target:
        out = out.withColumn("progress", ratio(F.col("value"), F.lit(spec.target)))
    if spec.row_limit:
        ties = [*(["period"] if spec.grain and not spec.headline else []), *by]
        if spec.sort_by_value or not ties:
            out = top_k(out, "value", spec.row_limit, ties)
        else:
            newest_first = [F.desc(c) if c == "period" else F.asc(c) for c in ties]
            out = out.orderBy(*newest_first).limit(spec.row_limit)
    return out


def total(column: str) -> Callable[[], Column]:
    return lambda: money_sum(column)


def absolute_total(column: str) -> Callable[[], Column]:
    """Saved metric of the dashboard dataset."""
    return lambda: F.abs(money_sum(column))


def row_count() -> Column:
    return F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint")


def total_of_rows() -> Column:
    times = F.col("n_rows").cast("decimal(18,0)")
    return F.sum((F.col("amount").cast(MONEY) * times).cast(MONEY_SUM)).cast(MONEY_SUM)


def saving_rate() -> Column:
    """NULL for a period without income."""
    return ratio(F.sum("cash_amount"), F.sum("income"))


def _monthly(column: str, **more) -> MetricSpec:
    reads = ("transaction_date", column, *([more["only_if"]] if "only_if" in more else []))
    return MetricSpec("dashboard", reads, total(column), **{"time_column": "transaction_date", "grain": "P1M", **more})


# Definitions of the finance dashboard.
ROW_LIMIT = 10_000
FINANCIAL_INDEPENDENCE = 1_200_000
ACTIVITY_RANGE = (dt.date(2020, 3, 1), dt.date(2023, 4, 29))

NET_WORTH = _monthly("transaction_amount", cumulative=True, compare_lag=1)
CASH = _monthly("transaction_amount", only_if="account_is_cash", cumulative=True, compare_lag=1)
INCOME = _monthly("income")
SPENDING = _monthly("spending")
PASSIVE_INCOME = MetricSpec(
    "dashboard",
    ("year_month", "transaction_amount", "is_passive"),
    total("transaction_amount"),
    "year_month",
    "P1M",
    only_if="is_passive",
)
UNACCOUNTED_SPENDING = _monthly("spending", only_if="is_unaccounted")
SAVING_RATE = MetricSpec(
    "dashboard", ("year_month", "cash_amount", "income"), saving_rate, "year_month", "P1M"
)
FI_PROGRESS = MetricSpec(
    "dashboard",
    ("transaction_amount",),
    total("transaction_amount"),
    target=FINANCIAL_INDEPENDENCE,
)
ACTIVITY = MetricSpec(
    "dashboard",
    ("transaction_date", "transaction_amount"),
    total("transaction_amount"),
    "transaction_date",
    "P1D",
    time_range=ACTIVITY_RANGE,
    rolling=30,
    row_limit=ROW_LIMIT,
)
EXPENSES = MetricSpec(
    "dashboard",
    ("transaction_date", "transaction_amount", "budget_category", "budget_is_expense"),
    absolute_total("transaction_amount"),
    "transaction_date",
    "P1M",
    time_range="last year",
    only_if="budget_is_expense",
    group_by=("budget_category",),
    row_limit=ROW_LIMIT,
    sort_by_value=True,
)
CASH_FLOW = MetricSpec(
    "cash_flow",
    ("year_month", "src", "dest", "amount"),
    total("amount"),
    "year_month",
    time_range="last month",
    group_by=("src", "dest"),
    row_limit=ROW_LIMIT,
    sort_by_value=True,
)
# over the counts per account and amount, which say how often the mart would list an amount
UNCLEARED_BALANCE = MetricSpec("uncleared", ("amount", "n_rows"), total_of_rows)
UNCLEARED_COUNT = MetricSpec("uncleared", ("n_rows",), row_count)

UNCLEARED_ROWS_LIMIT = 1_000
UNCLEARED_COLUMNS = (
    "transaction_date",
    "transaction_description",
    "transaction_amount",
    "in_accounting",
    "in_vendor",
)

METRICS = {
    "net_worth": NET_WORTH,
    "cash": CASH,
    "income": INCOME,
    "spending": SPENDING,
    "passive_income": PASSIVE_INCOME,
    "unaccounted_spending": UNACCOUNTED_SPENDING,
    "saving_rate": SAVING_RATE,
    "fi_progress": FI_PROGRESS,
    "activity": ACTIVITY,
    "expenses": EXPENSES,
    "cash_flow_top": CASH_FLOW,
    "uncleared_balance": UNCLEARED_BALANCE,
    "uncleared_count": UNCLEARED_COUNT,
}


def uncleared_rows(mart: DataFrame, limit: int = UNCLEARED_ROWS_LIMIT) -> DataFrame:
    """The first rows of the uncleared mart in date order; the order makes the choice repeatable."""
    order = [F.col(c).asc_nulls_last() for c in UNCLEARED_COLUMNS]
    return mart.select(*UNCLEARED_COLUMNS).orderBy(*order).limit(limit)
