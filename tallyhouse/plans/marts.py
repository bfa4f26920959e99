"""Marts."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions.keys import import_id
from tallyhouse.functions.money import MONEY, MONEY_SUM, money_sum, to_milliunits
from tallyhouse.operators.joins import anti_join, full_join, semi_join
from tallyhouse.operators.ranks import rank_in_key

YES, NO = "✔️", "❌"


def _one_sided(condition: Column) -> Column:
    own_cash = F.col("transfer_account_id").isNull() & F.col("is_cash")
    return F.when(condition & own_cash, F.col("amount")).otherwise(F.lit(0)).cast(MONEY)


def _dashboard_columns() -> dict[str, tuple[str | None, Column]]:
    """Column of the mart -> (dimension it needs, expression)."""
    c, no, zero = F.col, F.lit(False), F.lit(0)
    return {
        "year_month": ("date", c("year_month")),
        "year_month_week": ("date", c("year_month_week")),
        "transaction_amount": (None, c("amount")),
        "transaction_date": (None, c("date_id")),
        "transaction_description": (None, c("description")),
        "transaction_clearing_status": (None, c("clearing_status")),
        "account_is_cash": ("account", c("is_cash")),
        "budget_category_group_id": ("category", c("category_group_id")),
        "cash_amount": ("account", F.when(c("is_cash"), c("amount")).otherwise(zero).cast(MONEY)),
        "transaction_is_transfer": (None, c("transfer_account_id").isNotNull()),
        "budget_category_group": ("category", F.coalesce("category_group", F.lit("Unknown Category Group"))),
        "budget_category": ("category", F.coalesce("category_name", F.lit("Unknown Category"))),
        "budget_is_expense": ("category", F.coalesce("is_expense", no)),
        "payee_name": ("payee", F.coalesce("payee", F.lit("Unknown Payee"))),
        "spending": ("account", _one_sided(c("amount") < 0)),
        "is_unaccounted": ("payee", F.coalesce("is_unaccounted", no)),
        "income": ("account", _one_sided(c("amount") > 0)),
        "is_passive": ("payee", F.coalesce("is_passive", no)),
    }


@dataclass(frozen=True)
class Dimensions:
    """The dimensions of the dashboard, each made only when it is joined."""

    account: Callable[[], DataFrame]
    date: Callable[[], DataFrame]
    category: Callable[[], DataFrame]
    payee: Callable[[], DataFrame]


def mart_dashboard(
    transactions: DataFrame, dims: Dimensions, columns: Collection[str] | None = None
) -> DataFrame:
    """Transactions with the attributes of their four dimensions.

    With ``columns`` only these are computed. A dimension that none of them needs is not
    joined: its key is unique, so a left join to it changes neither rows nor values, but
    Spark cannot know that and would keep the join.
    """
    available = _dashboard_columns()
    wanted = list(available if columns is None else [c for c in available if c in columns])
    needed = {available[c][0] for c in wanted}
    rows = transactions
    if "account" in needed:
        account = dims.account().select(F.col("id").alias("_account"), "is_cash")
        rows = rows.join(account, F.col("account_id") == F.col("_account"), "left")
    if "date" in needed:
        # bounded by the calendar (some 20,000 days), never by the facts
        day = F.broadcast(dims.date().select(F.col("id").alias("_day"), "year_month", "year_month_week"))
        rows = rows.join(day, F.col("date_id") == F.col("_day"), "left")
    if "category" in needed:
        category = dims.category().select(
            F.col("id").alias("_category"),
            F.col("name").alias("category_name"),
            "category_group_id",
            "category_group",
            "is_expense",
        )
        rows = rows.join(category, F.col("category_id") == F.col("_category"), "left")
    if "payee" in needed:
        payee = dims.payee().select(
            F.col("id").alias("_payee"), F.col("name").alias("payee"), "is_unaccounted", "is_passive"
        )
        rows = rows.join(payee, F.col("payee_id") == F.col("_payee"), "left")
    return rows.select([available[c][1].alias(c) for c in wanted])


def needs_category(columns: Collection[str]) -> bool:
    return any(_dashboard_columns()[c][0] == "category" for c in columns)


CASH_FLOW_INPUT = (
    "year_month",
    "payee_name",
    "income",
    "spending",
    "budget_category_group",
    "budget_category_group_id",
    "account_is_cash",
    "transaction_is_transfer",
    "transaction_amount",
)


def _outflow() -> Column:
    return F.least("transaction_amount", F.lit(0).cast(MONEY))


DAILY_KEYS = (
    "transaction_date",
    "year_month",
    "payee_name",
    "budget_category",
    "budget_category_group",
    "budget_category_group_id",
    "account_is_cash",
    "transaction_is_transfer",
    "budget_is_expense",
    "is_unaccounted",
    "is_passive",
)
DAILY_SUMS = ("transaction_amount", "cash_amount", "income", "spending")


def mart_daily(dashboard: DataFrame) -> DataFrame:
    """The dashboard summed up per day, payee, category and flags.

    Sums add up again, so every metric and the cash flows can be had from it instead of the
    dashboard. ``outflow`` sums the negative amounts, which can't be told from summed amounts.
    """
    sums = [money_sum(c).alias(c) for c in DAILY_SUMS]
    return dashboard.groupBy(*DAILY_KEYS).agg(*sums, money_sum(_outflow()).alias("outflow"), F.count("*").alias("n_rows"))


def mart_cash_flow(dashboard: DataFrame, investment_group: str) -> DataFrame:
    """Money flows per month as weighted edges (src, dest).

    The wide table is read once: it is first summed to (month, payee, group), and the
    per-payee, per-group and per-month sums that the edges need are grouping sets of
    that much smaller result.
    """
    c = F.col
    invested = (
        (c("budget_category_group_id") == investment_group) & c("account_is_cash") & c("transaction_is_transfer")
    )
    cells = dashboard.groupBy("year_month", "payee_name", "budget_category_group").agg(
        money_sum("income").alias("income"),
        money_sum("spending").alias("spending"),
        money_sum(F.when(invested, c("outflow") if "outflow" in dashboard.columns else _outflow())).alias("invested"),
        money_sum(F.when(c("account_is_cash"), c("transaction_amount"))).alias("cash"),
    )
    by_payee, by_group, by_month = (
        [c("year_month"), c("payee_name")],
        [c("year_month"), c("budget_category_group")],
        [c("year_month")],
    )
    sums = cells.groupingSets(
        [by_payee, by_group, by_month], "year_month", "payee_name", "budget_category_group"
    ).agg(
        F.grouping("payee_name").alias("no_payee"),
        F.grouping("budget_category_group").alias("no_group"),
        *[F.sum(name).cast(MONEY_SUM).alias(name) for name in ("income", "spending", "invested", "cash")],
    )

    def edge(src: Column | str, dest: Column | str, amount: Column) -> Column:
        src, dest = (F.lit(e) if isinstance(e, str) else e for e in (src, dest))
        return F.struct(src.alias("src"), dest.alias("dest"), amount.cast(MONEY_SUM).alias("amount"))

    income, spent, zero = c("income"), F.abs("spending"), F.lit(0).cast(MONEY_SUM)
    edges = (
        F.when(c("no_payee") == 0, F.array(edge(c("payee_name"), "Income", income)))
        .when(c("no_group") == 0, F.array(edge("Spending", c("budget_category_group"), spent)))
        .otherwise(
            F.array(
                edge("Income", "Spending", F.least(spent, income)),
                edge("Spent Savings", "Spending", F.greatest(spent - income, zero)),
                edge("Income", "Savings", F.greatest(income - spent, zero)),
                edge("Savings", "Investment", F.abs("invested")),
                edge("Savings", "Cash", c("cash")),
            )
        )
    )
    return sums.select("year_month", F.inline(edges)).filter("amount > 0")


def split_totals(unique_transactions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions that have parts, as one row each."""
    return (
        semi_join(unique_transactions, transactions, "id", "super_id")
        .groupBy("id", F.col("date").alias("date_id"), "account_id", "description", "clearing_status")
        .agg(money_sum("amount").alias("amount"))
    )


ENTRY = ["id", "date_id", "account_id", "description", "amount"]


def uncleared_ledger(unique_transactions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Uncleared whole transactions, and split ones put together again, from the split fact."""
    amount = F.col("amount").cast(MONEY_SUM).alias("amount")
    uncleared = F.col("clearing_status") == "uncleared"
    whole = transactions.filter(uncleared & F.col("super_id").isNull()).select(*ENTRY[:-1], amount)
    regrouped = split_totals(unique_transactions, transactions).filter(uncleared).select(*ENTRY[:-1], amount)
    return whole.unionByName(regrouped)


def uncleared_sides(
    unique_transactions: DataFrame, bank_transactions: DataFrame, accounts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Uncleared ledger entries, and bank entries since the last reconciliation.

    A bank shows a split transaction as one entry, so the ledger side is whole
    transactions plus split ones put together again from their parts' owner. Every
    transaction is one or the other, and both give its own row: the ledger side is the
    uncleared transactions before splitting, without a pass over the fact.
    """
    columns = ENTRY
    ledger = unique_transactions.filter(F.col("clearing_status") == "uncleared").select(
        "id", F.col("date").alias("date_id"), *columns[2:4], F.col("amount").cast(MONEY_SUM).alias("amount")
    )
    reconciled = accounts.select(F.col("id").alias("account_id"), "last_reconciled_at")
    bank = (
        bank_transactions.join(reconciled, "account_id")
        .filter(F.col("date_id").cast("timestamp_ntz") > F.col("last_reconciled_at"))
        .select(*columns[:-1], F.col("amount").cast(MONEY_SUM).alias("amount"))
    )
    return ledger, bank


def uncleared_pair_counts(ledger: DataFrame, bank: DataFrame) -> DataFrame:
    """Rows of the uncleared mart per account and amount, without listing the pairs.

    Entries are counted per side before they meet, so a frequent amount costs no more than a rare
    one. Entries without an account or an amount match nothing.
    """
    sides = [
        side.select("account_id", "amount", F.lit(own).alias("l"), F.lit(1 - own).alias("b"))
        for side, own in ((ledger, 1), (bank, 0))
    ]
    n, m = F.col("n_ledger"), F.col("n_bank")
    known = F.col("account_id").isNotNull() & F.col("amount").isNotNull()
    return (
        sides[0].unionAll(sides[1])
        .groupBy("account_id", "amount")
        .agg(F.sum("l").alias("n_ledger"), F.sum("b").alias("n_bank"))
        .withColumn("n_rows", F.when(known & (n > 0) & (m > 0), n * m).otherwise(n + m))
    )


def _in_order(ledger: DataFrame, bank: DataFrame) -> DataFrame:
    """The n-th ledger entry of an account and amount beside the n-th bank entry, in the order of date and id.

    Entries without an account or an amount stand alone.
    """
    keys, own = ["account_id", "amount"], ["id", "date_id", "description"]
    both = ledger.select(*keys, *own, F.lit("ledger").alias("side")).unionByName(bank.select(*keys, *own, F.lit("bank").alias("side")))
    placed = rank_in_key(both, [*keys, "side"], [F.col(c).asc_nulls_last() for c in ("date_id", "id")], "place")
    known = F.col("account_id").isNotNull() & F.col("amount").isNotNull()
    alone = F.when(~known, F.col("side")).alias("alone")
    entry = {name: F.max(F.when(F.col("side") == name, F.struct(*own))).alias(name) for name in ("ledger", "bank")}
    met = placed.groupBy(*keys, "place", alone).agg(*entry.values())
    return met.select(*keys, *(F.col(f"{name}.{c}").alias(f"{name}_{c}") for name in entry for c in own))


def mart_uncleared(ledger: DataFrame, bank: DataFrame, one_to_one: bool = False) -> DataFrame:
    """Uncleared ledger entries beside bank entries since the last reconciliation.

    Entries are possible matches when account and amount agree, so equal amounts give every
    combination. With ``one_to_one`` an entry matches at most one: equal amounts of an account
    are matched in the order of date and id.
    """
    keys = ["account_id", "amount"]
    sides = [
        side.withColumnsRenamed({c: f"{name}_{c}" for c in ("id", "date_id", "description")})
        for name, side in (("ledger", ledger), ("bank", bank))
    ]

    def mark(ident: str) -> Column:
        return F.when(F.col(ident).isNotNull(), F.lit(YES)).otherwise(F.lit(NO))

    return (_in_order(ledger, bank) if one_to_one else full_join(*sides, keys)).select(
        F.coalesce("ledger_date_id", "bank_date_id").alias("transaction_date"),
        F.coalesce("ledger_description", "bank_description").alias("transaction_description"),
        F.col("amount").alias("transaction_amount"),
        mark("ledger_id").alias("in_accounting"),
        mark("bank_id").alias("in_vendor"),
    )


def mart_ledger_import(
    legs: DataFrame,
    transactions: DataFrame,
    payee_id: str,
    category_id: str,
) -> DataFrame:
    """Billed trip legs that the ledger has no entry for, as records ready for import.

    Legs billed together share a ``split_id``.
    """
    billed = legs.filter(F.col("is_billed") & F.col("account_id").isNotNull())
    missing = anti_join(billed, transactions, "billing_ref", "description")
    return missing.select(
        "account_id",
        F.col("travel_date_id").alias("date"),
        "updated_at",
        to_milliunits(-F.col("cost_sgd")).alias("amount"),
        F.lit(payee_id).alias("payee_id"),
        F.lit(category_id).alias("category_id"),
        F.lit("uncleared").alias("cleared"),
        F.lit(False).alias("approved"),
        F.lit(None).cast("string").alias("flag_color"),
        F.lit(payee_id).alias("split_payee_id"),
        F.col("billing_ref").alias("split_memo"),
        import_id("id").alias("import_id"),
        F.concat("source", F.lit(" -> "), "destination").alias("memo"),
        F.concat(F.lit("public_transport:"), "billing_ref").alias("split_id"),
    )
