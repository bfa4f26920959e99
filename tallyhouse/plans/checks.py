"""What must hold for every model: fixed values of the data contract, stated per table."""

from __future__ import annotations

from tallyhouse.operators.quality import Checks, Range

ACCOUNT_TYPES = (
    "checking",
    "savings",
    "cash",
    "creditCard",
    "lineOfCredit",
    "otherAsset",
    "otherLiability",
    "mortgage",
    "autoLoan",
    "studentLoan",
    "personalLoan",
    "medicalDebt",
    "otherDebt",
)
CLEARING = ("cleared", "uncleared", "reconciled")
GOALS = (
    "Target Category Balance",
    "Target Category Balance by Date",
    "Monthly Funding",
    "Plan Your Spending",
)
MODES = ("Rail", "Bus")
NOT_NEGATIVE = Range(low=0)
# A goal needs both a type and an amount, or neither.
GOAL_WHOLE = {"goal_complete": "(goal_type is null) = (coalesce(goal_amount, 0) = 0)"}
STATEMENT_ORDER = {
    "begin_before_end": "statement_begin <= statement_end",
    "end_before_scrape": "statement_end <= scraped_on",
}

STAGING = {
    "stg_budget": Checks("id name modified_at currency_code currency_symbol scraped_on"),
    "stg_budget_category": Checks(
        "id name budget_id category_group_id budget_amount budget_month is_deleted scraped_on",
        values={"goal_type": GOALS},
        holds=GOAL_WHOLE,
    ),
    "stg_category_group": Checks("id name is_deleted scraped_on"),
    "stg_account": Checks(
        "id name type on_budget is_closed is_deleted payee_id scraped_on",
        refers={"payee_id": ("stg_payee", "id")},
        values={"type": ACCOUNT_TYPES},
    ),
    "stg_payee": Checks("id name scraped_on", refers={"transfer_account_id": ("stg_account", "id")}),
    "stg_transaction": Checks(
        "id amount clearing_status is_approved is_deleted budget_id account_id date scraped_on",
        refers={
            "budget_id": ("stg_budget", "id"),
            "account_id": ("stg_account", "id"),
            "payee_id": ("stg_payee", "id"),
            "transfer_account_id": ("stg_account", "id"),
        },
        values={"clearing_status": CLEARING},
    ),
    "stg_subtransaction": Checks(
        "id super_id is_deleted amount scraped_on",
        refers={"payee_id": ("stg_payee", "id"), "transfer_account_id": ("stg_account", "id")},
    ),
    "stg_statement": Checks(
        "transacted_on description account_no name deposit withdrawal balance currency_code"
        " statement_begin statement_end scraped_on",
        ranges={"deposit": NOT_NEGATIVE, "withdrawal": NOT_NEGATIVE},
        holds=STATEMENT_ORDER,
    ),
    "stg_card": Checks("id name scraped_on"),
    "stg_trip_leg": Checks(
        "traveled_on cost_sgd source destination transport_mode card_id scraped_on",
        refers={"card_id": ("stg_card", "id")},
        values={"transport_mode": MODES},
        ranges={"cost_sgd": NOT_NEGATIVE},
    ),
}

SEEDS = {
    "payee_flag": Checks("payee_id is_unaccounted is_passive", unique="payee_id", refers={"payee_id": ("stg_payee", "id")}),
    "account_map": Checks(
        "budget_account_id vendor vendor_id",
        unique="budget_account_id",
        refers={"budget_account_id": ("stg_account", "id")},
    ),
    "card_map": Checks("bank_card_id vendor vendor_id", unique="bank_card_id"),
}

INTERMEDIATE = {
    "int_unique_budget_category": Checks(
        "id budget_id category_id name category_group_id is_deleted budget_amount budget_month updated_at",
        unique="id",
        refers={"budget_id": ("stg_budget", "id")},
        values={"goal_type": GOALS},
    ),
    "int_enriched_bank_statement": Checks(
        "id transacted_on description account_no account_id name deposit withdrawal balance"
        " currency_code statement_begin statement_end scraped_on",
        unique="id",
        refers={"account_id": ("dim_account", "id")},
        ranges={"deposit": NOT_NEGATIVE, "withdrawal": NOT_NEGATIVE},
        holds=STATEMENT_ORDER,
    ),
    "int_unique_transaction": Checks(
        "id amount clearing_status is_approved is_deleted budget_id account_id date scraped_on",
        unique="id",
        refers={
            "budget_id": ("stg_budget", "id"),
            "account_id": ("stg_account", "id"),
            "payee_id": ("stg_payee", "id"),
            "transfer_account_id": ("stg_account", "id"),
        },
        values={"clearing_status": CLEARING, "is_deleted": (False,)},
    ),
}

DIMENSIONS = {
    "dim_date": Checks(
        "id date day_of_month day_of_week weekday_name weekday_short year_month_week day_of_year"
        " week_of_year month_of_year month_name month_short quarter year_month year is_weekend updated_at",
        unique="id",
        ranges={
            "day_of_month": Range(1, 31),
            "day_of_week": Range(0, 6),
            "day_of_year": Range(1, 366),
            "week_of_year": Range(1, 53),
            "month_of_year": Range(1, 12),
            "quarter": Range(1, 4),
        },
        holds={"month_short": "length(month_short) = 3", "weekday_short": "length(weekday_short) = 3"},
    ),
    "dim_account": Checks(
        "id name is_closed is_deleted is_cash budget_type updated_at",
        unique="id",
        values={"budget_type": ACCOUNT_TYPES},
        # bank columns are set together or not at all
        holds={
            "vendor_whole": "(vendor is null) = (vendor_id is null) and (vendor_id is null) = (vendor_type is null)"
        },
    ),
    "dim_bank_card": Checks("id name updated_at", unique="id"),
    "dim_budget": Checks(
        "id name modified_at currency_code currency_symbol updated_at",
        unique="id",
        holds={"currency_code": "length(currency_code) = 3"},
    ),
    "dim_budget_category": Checks(
        "id category_id name budget_id is_deleted is_expense updated_at effective_at expired_at is_current",
        unique="id",
        refers={
            "budget_id": ("dim_budget", "id"),
            "category_group_id": ("stg_category_group", "id"),
        },
        values={"goal_type": GOALS},
        holds={"effective_before_expired": "effective_at < expired_at", **GOAL_WHOLE},
    ),
    "dim_payee": Checks(
        "id name updated_at is_unaccounted is_passive",
        unique="id",
        refers={"transfer_account_id": ("dim_account", "id")},
    ),
}

FACTS = {
    "fact_accounting_transaction": Checks(
        "id amount clearing_status is_approved budget_id account_id date_id updated_at",
        unique="id",
        refers={
            "super_id": ("stg_transaction", "id"),
            "budget_id": ("dim_budget", "id"),
            "account_id": ("dim_account", "id"),
            "category_id": ("dim_budget_category", "id"),
            "payee_id": ("dim_payee", "id"),
            "transfer_account_id": ("dim_account", "id"),
            "date_id": ("dim_date", "id"),
        },
        values={"clearing_status": CLEARING},
    ),
    "fact_monthly_budget": Checks(
        "id month_date_id budget_id category_id amount updated_at",
        unique="id",
        refers={
            "month_date_id": ("dim_date", "id"),
            "budget_id": ("dim_budget", "id"),
            "category_id": ("dim_budget_category", "id"),
        },
    ),
    "fact_trip_leg": Checks(
        "id traveled_on travel_date_id cost_sgd source destination transport_mode bank_card_id"
        " is_billed updated_at",
        unique="id",
        refers={
            "travel_date_id": ("dim_date", "id"),
            "bank_card_id": ("dim_bank_card", "id"),
            "account_id": ("dim_account", "id"),
        },
        values={"transport_mode": MODES},
        ranges={"cost_sgd": NOT_NEGATIVE},
    ),
    "fact_vendor_transaction": Checks(
        "id description date_id account_id amount updated_at",
        unique="id",
        refers={"date_id": ("dim_date", "id"), "account_id": ("dim_account", "id")},
    ),
    "fact_bank_statement": Checks(
        "id begin_date_id end_date_id account_id balance updated_at",
        unique="id",
        refers={
            "begin_date_id": ("dim_date", "id"),
            "end_date_id": ("dim_date", "id"),
            "account_id": ("dim_account", "id"),
        },
    ),
}

MARTS = {
    "mart_dashboard": Checks(
        "year_month year_month_week transaction_amount cash_amount transaction_date transaction_is_transfer"
        " transaction_clearing_status account_is_cash budget_category_group budget_category"
        " budget_is_expense payee_name spending is_unaccounted income is_passive",
        values={"transaction_clearing_status": CLEARING},
        ranges={"spending": Range(high=0), "income": NOT_NEGATIVE},
    ),
    "mart_cash_flow": Checks(
        "year_month src dest amount", ranges={"amount": Range(low=0, inclusive=False)}
    ),
    "mart_uncleared": Checks("transaction_date transaction_amount in_accounting in_vendor"),
    "mart_ledger_import": Checks(
        "import_id account_id amount payee_id category_id cleared approved",
        unique="import_id",
        refers={
            "account_id": ("stg_account", "id"),
            "payee_id": ("stg_payee", "id"),
            "category_id": ("stg_budget_category", "id"),
            "split_payee_id": ("stg_payee", "id"),
        },
        values={"cleared": CLEARING, "approved": (True, False)},
        holds={"import_id": "length(import_id) <= 36"},
    ),
}

ALL = {**STAGING, **SEEDS, **INTERMEDIATE, **DIMENSIONS, **FACTS, **MARTS}
