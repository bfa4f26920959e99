"""Staging models: source snapshots as typed rows, one row per entity and scrape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.dates import scraped_on
from tallyhouse.functions.money import from_milliunits, money
from tallyhouse.functions.text import blank_to_null, fare_amount, statement_day, statement_period
from tallyhouse.operators.unnest import unnest

# Labels of the budget API's goal codes.
GOAL_LABELS = {
    "TB": "Target Category Balance",
    "TBD": "Target Category Balance by Date",
    "MF": "Monthly Funding",
    "NEED": "Plan Your Spending",
}


def _goal_label(code: Column) -> Column:
    label = F.lit(None).cast("string")
    for key, text in GOAL_LABELS.items():
        label = F.when(code == key, F.lit(text)).otherwise(label)
    return label


def _entities(documents: DataFrame, array: str) -> DataFrame:
    """Rows of one array of the budget documents with ``budget_id`` and ``scraped_on``."""
    keep = {"budget_id": F.col("data.budget.id"), "scraped_on": scraped_on("date")}
    return unnest(documents, f"data.budget.{array}", keep)


def stg_budget(documents: DataFrame) -> DataFrame:
    b = "data.budget."
    return documents.select(
        F.col(b + "id").alias("id"),
        F.col(b + "name").alias("name"),
        F.col(b + "last_modified_on").cast("timestamp_ntz").alias("modified_at"),
        F.col(b + "currency_format.iso_code").alias("currency_code"),
        F.col(b + "currency_format.currency_symbol").alias("currency_symbol"),
        scraped_on("date").alias("scraped_on"),
    )


def stg_budget_category(documents: DataFrame) -> DataFrame:
    months = _entities(documents, "months")
    keep = {c: F.col(c) for c in ("budget_id", "scraped_on", "month")}
    return unnest(months, "categories", keep).select(
        "id",
        "name",
        "budget_id",
        "category_group_id",
        from_milliunits("budgeted").alias("budget_amount"),
        F.col("month").cast("date").alias("budget_month"),
        _goal_label(F.col("goal_type")).alias("goal_type"),
        from_milliunits("goal_target").alias("goal_amount"),
        F.col("goal_target_month").cast("date").alias("goal_due"),
        F.col("deleted").alias("is_deleted"),
        "scraped_on",
    )


def stg_category_group(documents: DataFrame) -> DataFrame:
    return _entities(documents, "category_groups").select(
        "id", "name", F.col("deleted").alias("is_deleted"), "scraped_on"
    )


def stg_account(documents: DataFrame) -> DataFrame:
    return _entities(documents, "accounts").select(
        "id",
        "name",
        "type",
        "on_budget",
        F.col("closed").alias("is_closed"),
        F.col("deleted").alias("is_deleted"),
        F.col("transfer_payee_id").alias("payee_id"),
        F.col("last_reconciled_at").cast("timestamp_ntz").alias("last_reconciled_at"),
        "scraped_on",
    )


def stg_payee(documents: DataFrame) -> DataFrame:
    return _entities(documents, "payees").select("id", "name", "transfer_account_id", "scraped_on")


def stg_transaction(documents: DataFrame) -> DataFrame:
    return _entities(documents, "transactions").select(
        "id",
        from_milliunits("amount").alias("amount"),
        F.col("memo").alias("description"),
        F.col("cleared").alias("clearing_status"),
        F.col("approved").alias("is_approved"),
        F.col("deleted").alias("is_deleted"),
        "budget_id",
        "category_id",
        "account_id",
        "payee_id",
        "transfer_account_id",
        F.col("date").cast("date").alias("date"),
        "scraped_on",
        "matched_transaction_id",
    )


def stg_subtransaction(documents: DataFrame) -> DataFrame:
    return _entities(documents, "subtransactions").select(
        "id",
        F.col("transaction_id").alias("super_id"),
        F.col("memo").alias("description"),
        "category_id",
        "payee_id",
        "transfer_account_id",
        F.col("deleted").alias("is_deleted"),
        from_milliunits("amount").alias("amount"),
        "scraped_on",
    )


def stg_card(legs: DataFrame) -> DataFrame:
    """Cards seen in the transit rows, one row per card, name and scrape."""
    return legs.select(
        F.col("card_id").alias("id"),
        F.col("card_name").alias("name"),
        F.col("scraped_on").cast("timestamp_ntz").alias("scraped_on"),
    ).distinct()


def stg_trip_leg(legs: DataFrame) -> DataFrame:
    return legs.select(
        "trip_id",
        blank_to_null("posting_ref").alias("posting_ref"),
        F.col("traveled_on").cast("timestamp_ntz").alias("traveled_on"),
        fare_amount("cost_sgd").alias("cost_sgd"),
        "source",
        "destination",
        F.col("mode").alias("transport_mode"),
        "card_id",
        F.col("scraped_on").cast("timestamp_ntz").alias("scraped_on"),
    )


def stg_statement(rows: DataFrame) -> DataFrame:
    begin, end = statement_period("Statement Period")
    return rows.select(
        statement_day("Transaction Date").alias("transacted_on"),
        F.col("Transaction Description").alias("description"),
        F.col("Account Number").alias("account_no"),
        F.col("Account Type").alias("name"),
        F.coalesce(money("Deposit"), money(F.lit(0))).alias("deposit"),
        F.coalesce(money("Withdrawal"), money(F.lit(0))).alias("withdrawal"),
        money("Available Balance").alias("balance"),
        F.col("Currency").alias("currency_code"),
        begin.alias("statement_begin"),
        end.alias("statement_end"),
        scraped_on("date").alias("scraped_on"),
    )
