"""Facts and the intermediate models below them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.dates import month_start, singapore_to_utc
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.functions.money import MONEY
from tallyhouse.operators.dedupe import earliest_per_key, first_per_key, latest_per_key, newest, oldest
from tallyhouse.operators.joins import either_key_left_join

STATEMENT_KEY = ("account_no", "statement_begin", "statement_end")
BANK_ROW_KEY = ("account_no", "transacted_on", "description")
# Rows of one scrape are equally new, so the remaining values decide between them.
STATEMENT_TIES = ["transacted_on", "description", "balance", "deposit", "withdrawal"]


def int_unique_transaction(transactions: DataFrame) -> DataFrame:
    """Newest version of each transaction, without those whose newest version is deleted.

    The filter must follow the choice: filtering first would revive older versions.
    """
    return latest_per_key(transactions, ["id"], ties=["amount", "description"]).filter(~F.col("is_deleted"))


def int_unique_subtransaction(subtransactions: DataFrame) -> DataFrame:
    """Newest version of each part, deleted ones included."""
    return latest_per_key(subtransactions, ["id"], ties=["super_id", "amount"])


def int_split_transaction(
    unique_transactions: DataFrame, unique_parts: DataFrame, drop_deleted_parts: bool = False
) -> DataFrame:
    """One row per transaction, or per part when a transaction is split.

    Parts point at their transaction's id or at the id of the transaction merged into it.
    """
    parts = unique_parts.filter(~F.col("is_deleted")) if drop_deleted_parts else unique_parts
    parts = parts.drop("is_deleted")
    split = either_key_left_join(
        unique_transactions, parts, "id", "matched_transaction_id", "super_id", prefix="part_"
    )
    return split.select(
        "budget_id",
        "clearing_status",
        "is_approved",
        "account_id",
        F.col("date").alias("date_id"),
        F.when(F.col("part_super_id") == F.col("matched_transaction_id"), F.col("id"))
        .otherwise(F.col("part_super_id"))
        .alias("super_id"),
        F.coalesce("part_id", "id").alias("id"),
        *[
            F.coalesce("part_" + c, c).alias(c)
            for c in ("description", "payee_id", "transfer_account_id", "amount")
        ],
        F.coalesce("part_category_id", "category_id").alias("source_category_id"),
        F.greatest("part_scraped_on", "scraped_on").alias("updated_at"),
    )


def fact_accounting_transaction(split_transactions: DataFrame, unique_categories: DataFrame) -> DataFrame:
    """Transactions and parts, each with its category's row for the month of the transaction."""
    # A category's history row for a month is keyed like its unique row, so the history's own
    # window and group join are not needed here.
    month_rows = unique_categories.select(
        F.col("id").alias("category_id"),
        F.col("category_id").alias("_category"),
        F.col("budget_month").alias("_month"),
    )
    return split_transactions.join(
        month_rows,
        (F.col("source_category_id") == F.col("_category")) & (month_start("date_id") == F.col("_month")),
        "left",
    ).drop("_category", "_month")


def fact_monthly_budget(unique_categories: DataFrame) -> DataFrame:
    return unique_categories.select(
        "id",
        F.col("budget_month").alias("month_date_id"),
        "budget_id",
        F.col("id").alias("category_id"),
        F.col("budget_amount").alias("amount"),
        "updated_at",
    )


def _account_of(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add the id of the account that a statement row's account number is mapped to."""
    known = accounts.select(F.col("id").alias("account_id"), F.col("vendor_id").alias("_vendor_id"))
    return rows.join(known, F.col("account_no") == F.col("_vendor_id"), "left").drop("_vendor_id")


def int_enriched_bank_statement(
    statements: DataFrame, accounts: DataFrame, key_cols: Sequence[str] = BANK_ROW_KEY
) -> DataFrame:
    """Newest version of each bank row, keyed by a hash, with its account."""
    keyed = statements.withColumn("id", surrogate_key(*key_cols))
    return _account_of(latest_per_key(keyed, ["id"], ties=STATEMENT_TIES), accounts)


def fact_vendor_transaction(bank_rows: DataFrame, opening: str = "after") -> DataFrame:
    """Every bank row as a signed movement, with one opening row per account.

    The opening amount is the balance of the account's earliest row. That balance is
    the one *after* the row's own movement; ``opening="before"`` takes the movement off,
    so that all amounts add up to the closing balance.
    """
    movement = (F.col("deposit") - F.col("withdrawal")).cast(MONEY)
    first = earliest_per_key(bank_rows, ["account_id"], ties=["transacted_on", "id"])
    opening_amount = F.col("balance") if opening == "after" else F.col("balance") - movement
    openings = first.select(
        surrogate_key("account_id").alias("id"),
        F.col("statement_begin").cast("date").alias("date_id"),
        "account_id",
        F.lit("Initial Balance").alias("description"),
        F.col("scraped_on").alias("updated_at"),
        opening_amount.cast(MONEY).alias("amount"),
    )
    movements = bank_rows.select(
        "id",
        F.col("transacted_on").alias("date_id"),
        "account_id",
        "description",
        F.col("scraped_on").alias("updated_at"),
        movement.alias("amount"),
    )
    return openings.unionByName(movements)


def fact_bank_statement(
    statements: DataFrame, accounts: DataFrame, key_cols: Sequence[str] = STATEMENT_KEY
) -> DataFrame:
    """One row per statement, with the balance of its latest row."""
    keyed = statements.withColumn("id", surrogate_key(*key_cols))
    order = [newest("scraped_on"), newest("transacted_on"), *map(oldest, STATEMENT_TIES)]
    return _account_of(first_per_key(keyed, ["id"], order), accounts).select(
        "id",
        F.col("statement_begin").alias("begin_date_id"),
        F.col("statement_end").alias("end_date_id"),
        "account_id",
        "balance",
        F.col("scraped_on").alias("updated_at"),
    )


def fact_trip_leg(
    legs: DataFrame, card_map: DataFrame, accounts: DataFrame, key_cols: Sequence[str] = ("trip_id",)
) -> DataFrame:
    """Newest version of each trip leg with the account that pays for its card.

    ``traveled_on`` is wall-clock time in UTC; ``travel_date_id`` is the local day.
    """
    unique_legs = latest_per_key(legs, list(key_cols), ties=["traveled_on", "source", "destination", "cost_sgd"])
    cards = card_map.withColumnsRenamed({"vendor": "_vendor", "vendor_id": "_vendor_id"})
    payers = accounts.select(F.col("id").alias("account_id"), "vendor", "vendor_id")
    return (
        unique_legs.select(
            F.col("trip_id").alias("id"),
            "trip_id",
            "cost_sgd",
            "source",
            "destination",
            "transport_mode",
            "scraped_on",
            F.col("posting_ref").alias("billing_ref"),
            F.col("posting_ref").isNotNull().alias("is_billed"),
            singapore_to_utc("traveled_on").alias("traveled_on"),
            F.col("scraped_on").alias("updated_at"),
            F.to_date("traveled_on").alias("travel_date_id"),
            F.col("card_id").alias("_card_id"),
        )
        .join(cards, F.col("_card_id") == F.col("bank_card_id"), "left")
        .drop("bank_card_id")
        .withColumnRenamed("_card_id", "bank_card_id")
        .join(
            payers,
            (F.col("_vendor") == F.col("vendor")) & (F.col("_vendor_id") == F.col("vendor_id")),
            "left",
        )
        .drop("_vendor", "_vendor_id", "vendor", "vendor_id")
    )
