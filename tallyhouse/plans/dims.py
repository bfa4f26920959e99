"""Dimensions and the intermediate models below them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.dates import add_years, date_literal
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.operators.calendar import calendar, day_spine
from tallyhouse.operators.dedupe import first_per_key, latest_per_key, newest as newest_first, oldest, without
from tallyhouse.operators.scd import with_validity

# Fixed values
CALENDAR_START = dt.date(2019, 1, 1)
CALENDAR_YEARS_AHEAD = 20
BANK_VENDOR = "UOB"
EXPENSE_PREFIX = "Expenses"


def dim_date(
    spark: SparkSession,
    as_of: dt.date,
    start: dt.date = CALENDAR_START,
    years_ahead: int = CALENDAR_YEARS_AHEAD,
) -> DataFrame:
    """Calendar from ``start`` up to ``years_ahead`` years after ``as_of``."""
    today = date_literal(as_of)
    days = day_spine(spark.range(1), date_literal(start), add_years(today, years_ahead))
    return calendar(days, today)


def int_mapped_account(
    accounts: DataFrame, account_map: DataFrame, bank_vendor: str = BANK_VENDOR
) -> DataFrame:
    """Newest budget accounts with the bank account number they are mapped to: the first one, if several."""
    own = without(latest_per_key(accounts, ["id"], ties=["name"]), "payee_id").withColumnsRenamed(
        {"type": "budget_type", "on_budget": "is_cash"}
    )
    # a second row for an account would double its transactions wherever accounts are joined
    mapped = first_per_key(
        account_map.filter(F.col("vendor") == bank_vendor), ["budget_account_id"], [oldest("vendor_id")]
    )
    return own.join(mapped, own["id"] == mapped["budget_account_id"], "left").select(
        *own.columns, "vendor", "vendor_id"
    )


def dim_account(mapped_accounts: DataFrame, statements: DataFrame) -> DataFrame:
    """Mapped accounts with the newest name of their bank account."""
    bank = latest_per_key(
        statements.select("account_no", "name", "scraped_on"), ["account_no"], ties=["name"]
    ).select("account_no", F.col("name").alias("vendor_type"), F.col("scraped_on").alias("_bank_scraped_on"))
    return (
        mapped_accounts.join(bank, F.col("vendor_id") == F.col("account_no"), "left")
        .withColumn("updated_at", F.greatest("scraped_on", "_bank_scraped_on"))
        .drop("account_no", "_bank_scraped_on")
    )


def dim_bank_card(cards: DataFrame) -> DataFrame:
    return latest_per_key(cards, ["id"], ties=["name"]).select(
        "id", "name", F.col("scraped_on").alias("updated_at")
    )


def dim_budget(budgets: DataFrame) -> DataFrame:
    newest = latest_per_key(budgets, ["id"], ties=["modified_at", "name"])
    return newest.withColumnRenamed("scraped_on", "updated_at")


def dim_payee(payees: DataFrame, flags: DataFrame) -> DataFrame:
    """Newest payees with their flags; a payee without flags has both false.

    Of several rows for a payee the first by name counts, and of these one that is flagged.
    """
    newest = latest_per_key(payees, ["id"], ties=["name"]).withColumnRenamed("scraped_on", "updated_at")
    order = [oldest("payee_name"), newest_first("is_unaccounted"), newest_first("is_passive")]
    flagged = first_per_key(flags, ["payee_id"], order).select("payee_id", "is_unaccounted", "is_passive")
    return newest.join(flagged, newest["id"] == flagged["payee_id"], "left").select(
        *newest.columns,
        F.coalesce("is_unaccounted", F.lit(False)).alias("is_unaccounted"),
        F.coalesce("is_passive", F.lit(False)).alias("is_passive"),
    )


def int_unique_budget_category(categories: DataFrame) -> DataFrame:
    """Newest row per category and month, keyed by a hash of both."""
    keyed = categories.withColumnsRenamed({"id": "category_id", "scraped_on": "updated_at"}).withColumn(
        "id", surrogate_key("category_id", "budget_month")
    )
    return latest_per_key(keyed, ["id"], "updated_at", ties=["name", "budget_amount"])


def dim_budget_category(unique_categories: DataFrame, groups: DataFrame) -> DataFrame:
    """Category history by month with the newest group. A group id without a group becomes NULL."""
    history = with_validity(unique_categories, "category_id", "budget_month")
    group = latest_per_key(groups, ["id"], ties=["name"]).select(
        F.col("id").alias("_group_id"), F.col("name").alias("category_group")
    )
    return history.join(group, F.col("category_group_id") == F.col("_group_id"), "left").select(
        "id",
        "category_id",
        "name",
        "budget_id",
        F.col("_group_id").alias("category_group_id"),
        "category_group",
        "goal_type",
        "goal_amount",
        "goal_due",
        "is_deleted",
        "updated_at",
        "effective_at",
        "expired_at",
        F.coalesce(F.startswith("category_group", F.lit(EXPENSE_PREFIX)), F.lit(False)).alias("is_expense"),
        "is_current",
    )
