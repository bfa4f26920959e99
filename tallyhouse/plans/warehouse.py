"""All models of the warehouse, wired to their inputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.operators.dedupe import first_per_key, newest, oldest
from tallyhouse.operators.quality import Checks, reconcile, run_checks
from tallyhouse.plans import checks, dims, facts, marts, metrics
from tallyhouse.sources.lake import TableStore


class Staging:
    """The staged inputs by name: ten staging models and three seeds.

    Each is given as a frame or as a function that makes it when it is first needed.
    """

    NAMES = (
        "stg_budget",
        "stg_budget_category",
        "stg_category_group",
        "stg_account",
        "stg_payee",
        "stg_transaction",
        "stg_subtransaction",
        "stg_statement",
        "stg_card",
        "stg_trip_leg",
        "payee_flag",
        "account_map",
        "card_map",
    )

    def __init__(self, **inputs: DataFrame | Callable[[], DataFrame]) -> None:
        unknown = set(inputs) - set(self.NAMES)
        if unknown:
            raise TypeError(f"not staged inputs: {sorted(unknown)}")
        self._inputs = inputs

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        given = self._inputs[name]
        frame = given if isinstance(given, DataFrame) else given()
        setattr(self, name, frame)
        return frame


@dataclass(frozen=True)
class Options:
    """``investment_group``, ``transport_payee`` and ``transport_category`` are ids of the user's own budget."""

    as_of: dt.date
    investment_group: str
    transport_payee: str
    transport_category: str
    calendar_start: dt.date = dims.CALENDAR_START
    calendar_years_ahead: int = dims.CALENDAR_YEARS_AHEAD
    bank_vendor: str = dims.BANK_VENDOR
    opening_balance: str = "after"
    metric_ranges: Mapping[str, tuple[dt.date, dt.date]] = field(default_factory=dict)


# What facts are joined with in the dashboard
LOOKUPS = frozenset(
    {"int_mapped_account", "int_unique_budget_category", "dim_budget_category", "dim_payee"}
)
# Facts' inputs that their readers go through twice or more
READ_AGAIN = frozenset({"int_unique_transaction", "int_unique_subtransaction", "int_enriched_bank_statement"})


class Warehouse:
    """Models as lazy frames.

    Without a store every model is a plan over the staged inputs. With a store each model
    is written once, when first used, and its readers start from the written table. That
    ends its lineage, so lost executors cost at most one model's recomputation, and it
    tells Spark the model's true size: a lookup table that is small gets broadcast, and a
    large one is joined by sorting. Of a plan with joins in it Spark expects the product
    of the inputs, and would shuffle the facts once for every dimension.

    ``stored`` limits the store to some models, such as ``LOOKUPS``.
    """

    def __init__(
        self,
        spark: SparkSession,
        staging: Staging,
        options: Options,
        store: TableStore | None = None,
        stored: Collection[str] | None = None,
    ) -> None:
        self.spark = spark
        self.staging = staging
        self.options = options
        self.store = store
        self.stored = stored

    def _is_stored(self, name: str) -> bool:
        return self.store is not None and (self.stored is None or name in self.stored)

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.store.write(name, build()) if self._is_stored(name) else build()

    # intermediate models: read several times, so stored as well
    @cached_property
    def int_unique_transaction(self) -> DataFrame:
        return self._table(
            "int_unique_transaction", lambda: facts.int_unique_transaction(self.staging.stg_transaction)
        )

    @cached_property
    def int_unique_subtransaction(self) -> DataFrame:
        return self._table(
            "int_unique_subtransaction",
            lambda: facts.int_unique_subtransaction(self.staging.stg_subtransaction),
        )

    @cached_property
    def int_unique_budget_category(self) -> DataFrame:
        return self._table(
            "int_unique_budget_category",
            lambda: dims.int_unique_budget_category(self.staging.stg_budget_category),
        )

    @cached_property
    def int_enriched_bank_statement(self) -> DataFrame:
        return self._table(
            "int_enriched_bank_statement",
            lambda: facts.int_enriched_bank_statement(
                self.staging.stg_statement, self.int_mapped_account
            ),
        )

    @cached_property
    def int_mapped_account(self) -> DataFrame:
        s = self.staging
        return self._table(
            "int_mapped_account",
            lambda: dims.int_mapped_account(s.stg_account, s.account_map, self.options.bank_vendor),
        )

    # ephemeral model: never stored, so that each reader computes only the columns it uses
    @cached_property
    def int_split_transaction(self) -> DataFrame:
        return facts.int_split_transaction(self.int_unique_transaction, self.int_unique_subtransaction)

    # dimensions
    @cached_property
    def dim_date(self) -> DataFrame:
        o = self.options
        return self._table(
            "dim_date",
            lambda: dims.dim_date(self.spark, o.as_of, o.calendar_start, o.calendar_years_ahead),
        )

    @cached_property
    def dim_account(self) -> DataFrame:
        return self._table(
            "dim_account",
            lambda: dims.dim_account(self.int_mapped_account, self.staging.stg_statement),
        )

    @cached_property
    def dim_bank_card(self) -> DataFrame:
        return self._table("dim_bank_card", lambda: dims.dim_bank_card(self.staging.stg_card))

    @cached_property
    def dim_budget(self) -> DataFrame:
        return self._table("dim_budget", lambda: dims.dim_budget(self.staging.stg_budget))

    @cached_property
    def dim_payee(self) -> DataFrame:
        s = self.staging
        return self._table("dim_payee", lambda: dims.dim_payee(s.stg_payee, s.payee_flag))

    @cached_property
    def dim_budget_category(self) -> DataFrame:
        return self._table(
            "dim_budget_category",
            lambda: dims.dim_budget_category(
                self.int_unique_budget_category, self.staging.stg_category_group
            ),
        )

    # facts
    @cached_property
    def fact_accounting_transaction(self) -> DataFrame:
        return self._table(
            "fact_accounting_transaction",
            lambda: facts.fact_accounting_transaction(
                self.int_split_transaction, self.int_unique_budget_category
            ),
        )

    @cached_property
    def fact_monthly_budget(self) -> DataFrame:
        return self._table(
            "fact_monthly_budget", lambda: facts.fact_monthly_budget(self.int_unique_budget_category)
        )

    @cached_property
    def fact_trip_leg(self) -> DataFrame:
        s = self.staging
        return self._table(
            "fact_trip_leg", lambda: facts.fact_trip_leg(s.stg_trip_leg, s.card_map, self.int_mapped_account)
        )

    @cached_property
    def fact_vendor_transaction(self) -> DataFrame:
        return self._table(
            "fact_vendor_transaction",
            lambda: facts.fact_vendor_transaction(
                self.int_enriched_bank_statement, self.options.opening_balance
            ),
        )

    @cached_property
    def fact_bank_statement(self) -> DataFrame:
        return self._table(
            "fact_bank_statement",
            lambda: facts.fact_bank_statement(self.staging.stg_statement, self.int_mapped_account),
        )

    # marts
    def _split_transactions(self) -> DataFrame:
        """The fact where it is stored, else without the category's key."""
        if self._is_stored("fact_accounting_transaction"):
            return self.fact_accounting_transaction
        return self.int_split_transaction

    def _dimensions(self) -> marts.Dimensions:
        return marts.Dimensions(
            lambda: self.int_mapped_account,
            lambda: self.dim_date,
            lambda: self.dim_budget_category,
            lambda: self.dim_payee,
        )

    @cached_property
    def mart_dashboard(self) -> DataFrame:
        return self._table(
            "mart_dashboard",
            lambda: marts.mart_dashboard(self.fact_accounting_transaction, self._dimensions()),
        )

    @cached_property
    def mart_daily(self) -> DataFrame:
        return self._table(
            "mart_daily", lambda: marts.mart_daily(self.dashboard((*marts.DAILY_KEYS, *marts.DAILY_SUMS)))
        )

    def _summed(self, columns: Collection[str]) -> DataFrame:
        """Rows that add up like the dashboard's: the daily sums where they are stored on purpose."""
        if self.stored is not None and self._is_stored("mart_daily"):
            return self.mart_daily
        return self.dashboard(columns)

    def dashboard(self, columns: Collection[str]) -> DataFrame:
        """Columns of the dashboard mart: read from the stored mart, else built without the
        dimensions that they do not need."""
        if self._is_stored("mart_dashboard"):
            return self.mart_dashboard.select(*columns)
        # the fact adds only the category's key to the split transactions
        by_category = marts.needs_category(columns)
        rows = self.fact_accounting_transaction if by_category else self._split_transactions()
        return marts.mart_dashboard(rows, self._dimensions(), columns)

    @cached_property
    def mart_cash_flow(self) -> DataFrame:
        return self._table(
            "mart_cash_flow",
            lambda: marts.mart_cash_flow(
                self._summed(marts.CASH_FLOW_INPUT), self.options.investment_group
            ),
        )

    @cached_property
    def mart_uncleared(self) -> DataFrame:
        return self._table(
            "mart_uncleared",
            lambda: marts.mart_uncleared(*self._uncleared_sides()),
        )

    def _uncleared_sides(self) -> tuple[DataFrame, DataFrame]:
        return marts.uncleared_sides(
            self.int_unique_transaction, self.fact_vendor_transaction, self.int_mapped_account
        )

    @property
    def uncleared_pair_counts(self) -> DataFrame:
        return marts.uncleared_pair_counts(*self._uncleared_sides())

    @property
    def uncleared_one_to_one(self) -> DataFrame:
        return marts.mart_uncleared(*self._uncleared_sides(), one_to_one=True)

    @property
    def uncleared_ledger(self) -> DataFrame:
        return marts.uncleared_ledger(self.int_unique_transaction, self.int_split_transaction)

    @cached_property
    def mart_ledger_import(self) -> DataFrame:
        o = self.options
        return self._table(
            "mart_ledger_import",
            lambda: marts.mart_ledger_import(
                self.fact_trip_leg,
                self._split_transactions(),
                o.transport_payee,
                o.transport_category,
            ),
        )

    # metrics
    def metric(self, name: str, as_of: dt.date | None = None, **changes) -> DataFrame:
        """A dashboard metric by name; ``changes`` replace fields of its definition.

        A time range in the warehouse's options replaces the metric's own.
        """
        spec = metrics.METRICS[name]
        if name in self.options.metric_ranges:
            changes = {"time_range": self.options.metric_ranges[name], **changes}
        if changes:
            spec = metrics.MetricSpec(**{**vars(spec), **changes})
        mart = {
            "dashboard": lambda: self._summed(spec.reads),
            "cash_flow": lambda: self.mart_cash_flow,
            "uncleared": lambda: self.uncleared_pair_counts,
        }[spec.source]()
        return metrics.run_metric(spec, mart, as_of or self.options.as_of)

    def uncleared_rows(self) -> DataFrame:
        return metrics.uncleared_rows(self.mart_uncleared)

    # checks
    def table(self, name: str) -> DataFrame:
        return getattr(self.staging if name in Staging.NAMES else self, name)

    def check(self, wanted: Mapping[str, Checks] = checks.ALL) -> DataFrame:
        """Failures of every check of the named tables."""
        names = set(wanted) | {parent for c in wanted.values() for parent, _ in c.refers.values()}
        return run_checks({name: self.table(name) for name in names}, wanted)

    def check_balances(self) -> DataFrame:
        """Accounts whose bank movements do not add up to the balance of their newest row."""
        order = [newest("scraped_on"), newest("transacted_on"), oldest("id")]
        closing = first_per_key(self.int_enriched_bank_statement, ["account_id"], order)
        return reconcile(
            closing.select("account_id", F.col("balance")),
            self.fact_vendor_transaction,
            "account_id",
            "balance",
            "amount",
        )

    def build(self) -> None:
        """Write every table model, in dependency order."""
        if self.store is None:
            raise ValueError("a warehouse without a store has nowhere to build to")
        for name in [*checks.INTERMEDIATE, *checks.DIMENSIONS, *checks.FACTS, *checks.MARTS]:
            getattr(self, name)
