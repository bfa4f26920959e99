"""Models on hand-made rows, and the wiring of the warehouse."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import dims, facts, marts, metrics
from tallyhouse.session import ensure_checkpoint_dir, scratch_dir
from tallyhouse.sources.lake import TableStore
from workload import adapters

SF = "/root/testdata/sf0.001"
TS1, TS2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
STATEMENT = (
    "transacted_on date, description string, account_no string, name string, deposit decimal(18,7),"
    " withdrawal decimal(18,7), balance decimal(18,7), currency_code string, statement_begin timestamp_ntz,"
    " statement_end timestamp_ntz, scraped_on timestamp_ntz"
)


def bank_rows(spark, *entries):
    """(day, description, account, deposit, withdrawal, balance[, month])"""
    data = []
    for day, text, account, deposit, withdrawal, balance in entries:
        d = dt.date(2024, 3, day)
        data.append(
            (d, text, account, "Savings", Decimal(deposit), Decimal(withdrawal), Decimal(balance), "SGD",
             dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 31), TS1)
        )
    return spark.createDataFrame(data, STATEMENT)


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame([("a1", "v1"), ("a2", "v2")], "id string, vendor_id string")


def test_equal_bank_rows_of_a_day_collapse(spark, rows, accounts):
    statements = bank_rows(spark, (1, "bus", "v1", 0, 2, 98), (1, "bus", "v1", 0, 2, 96), (2, "bus", "v1", 0, 2, 94))
    out = facts.int_enriched_bank_statement(statements, accounts)
    assert rows(out, "transacted_on", "balance") == [
        (dt.date(2024, 3, 1), Decimal("96.0000000")),
        (dt.date(2024, 3, 2), Decimal("94.0000000")),
    ]
    with_balance = facts.int_enriched_bank_statement(
        statements, accounts, ["account_no", "transacted_on", "description", "balance"]
    )
    assert with_balance.count() == 3


def test_unmapped_bank_account_has_no_account(spark, rows, accounts):
    out = facts.int_enriched_bank_statement(bank_rows(spark, (1, "x", "v9", 1, 0, 1)), accounts)
    assert rows(out, "account_no", "account_id") == [("v9", None)]


def test_opening_balance(spark, accounts):
    statements = bank_rows(spark, (1, "pay", "v1", 100, 0, 150), (2, "food", "v1", 0, 30, 120))
    unique = facts.int_enriched_bank_statement(statements, accounts)
    after = facts.fact_vendor_transaction(unique)
    before = facts.fact_vendor_transaction(unique, opening="before")
    assert [float(df.agg(F.sum("amount")).first()[0]) for df in (after, before)] == [220, 120]
    opening = after.filter("description = 'Initial Balance'").first()
    assert (opening["date_id"], opening["amount"]) == (dt.date(2024, 3, 1), Decimal(150))


def test_statements_of_two_accounts_stay_apart(spark, rows, accounts):
    statements = bank_rows(
        spark, (1, "x", "v1", 1, 0, 10), (5, "y", "v1", 1, 0, 11), (1, "x", "v2", 1, 0, 20)
    )
    out = facts.fact_bank_statement(statements, accounts)
    assert rows(out, "account_id", "balance") == [("a1", Decimal("11.0000000")), ("a2", Decimal("20.0000000"))]
    assert facts.fact_bank_statement(statements, accounts, ["statement_begin", "statement_begin"]).count() == 1


def test_trip_key(spark, accounts):
    data = [("trip", dt.datetime(2024, 3, 1, 7), "A", "B", TS1), ("trip", dt.datetime(2024, 3, 1, 8), "B", "C", TS1)]
    legs = spark.createDataFrame(
        data, "trip_id string, traveled_on timestamp_ntz, source string, destination string, scraped_on timestamp_ntz"
    ).withColumns(
        {"cost_sgd": F.lit(1), "transport_mode": F.lit("Bus"), "posting_ref": F.lit(None).cast("string"),
         "card_id": F.lit("k1")}
    )
    card_map = spark.createDataFrame([("k1", "UOB", "v1")], "bank_card_id string, vendor string, vendor_id string")
    payers = accounts.withColumn("vendor", F.lit("UOB"))
    by_trip = facts.fact_trip_leg(legs, card_map, payers)
    by_leg = facts.fact_trip_leg(legs, card_map, payers, ["trip_id", "traveled_on", "source", "destination"])
    assert (by_trip.count(), by_leg.count()) == (1, 2)
    row = by_trip.first()
    assert (row["account_id"], row["traveled_on"], row["is_billed"]) == ("a1", dt.datetime(2024, 2, 29, 23), False)
    assert row["travel_date_id"] == dt.date(2024, 3, 1)


TRANSACTION = (
    "id string, amount decimal(18,7), description string, clearing_status string, is_approved boolean,"
    " is_deleted boolean, budget_id string, category_id string, account_id string, payee_id string,"
    " transfer_account_id string, date date, scraped_on timestamp_ntz, matched_transaction_id string"
)
PART = (
    "id string, super_id string, description string, category_id string, payee_id string,"
    " transfer_account_id string, is_deleted boolean, amount decimal(18,7), scraped_on timestamp_ntz"
)


def test_split_transactions(spark, rows):
    day = dt.date(2024, 3, 5)

    def transaction(ident, matched=None):
        return (ident, Decimal(-9), "whole", "uncleared", True, False, "b", "c1", "a1", "p1", None, day, TS1, matched)

    unique = spark.createDataFrame([transaction("t1"), transaction("t2", "m2"), transaction("t3")], TRANSACTION)
    parts = spark.createDataFrame(
        [
            ("s1", "t1", "part", "c2", None, None, False, Decimal(-4), TS2),
            ("s2", "t1", None, None, "p2", None, True, Decimal(-5), TS1),
            ("s3", "m2", None, "c2", None, "a9", False, Decimal(-9), TS1),
        ],
        PART,
    )
    out = facts.int_split_transaction(unique, parts)
    assert rows(out, "id", "super_id", "description", "source_category_id", "payee_id", "transfer_account_id", "amount") == [
        ("s1", "t1", "part", "c2", "p1", None, Decimal("-4.0000000")),
        ("s2", "t1", "whole", "c1", "p2", None, Decimal("-5.0000000")),
        ("s3", "t2", "whole", "c2", "p1", "a9", Decimal("-9.0000000")),
        ("t3", None, "whole", "c1", "p1", None, Decimal("-9.0000000")),
    ]
    assert {r["id"]: r["updated_at"] for r in out.collect()}["s1"] == TS2
    assert rows(facts.int_split_transaction(unique, parts, drop_deleted_parts=True), "id") == [
        ("s1",), ("s3",), ("t3",)
    ]

    categories = spark.createDataFrame(
        [("h1", "c1", dt.date(2024, 3, 1)), ("h2", "c2", dt.date(2024, 2, 1))],
        "id string, category_id string, budget_month date",
    )
    fact = facts.fact_accounting_transaction(out, categories)
    assert rows(fact, "id", "category_id") == [("s1", None), ("s2", "h1"), ("s3", None), ("t3", "h1")]


def test_category_history(spark, rows):
    stg = spark.createDataFrame(
        [("c1", "old", "g1", dt.date(2024, 1, 1), TS1), ("c1", "new", "g1", dt.date(2024, 1, 1), TS2),
         ("c1", "next", "gone", dt.date(2024, 2, 1), TS1)],
        "id string, name string, category_group_id string, budget_month date, scraped_on timestamp_ntz",
    ).withColumns(
        {"budget_id": F.lit("b"), "budget_amount": F.lit(1), "goal_type": F.lit(None).cast("string"),
         "goal_amount": F.lit(0), "goal_due": F.lit(None).cast("date"), "is_deleted": F.lit(False)}
    )
    groups = spark.createDataFrame([("g1", "Expenses: Home", TS1)], "id string, name string, scraped_on timestamp_ntz")
    out = dims.dim_budget_category(dims.int_unique_budget_category(stg), groups)
    assert rows(out, "name", "category_group_id", "is_expense", "is_current") == [
        ("new", "g1", True, False),
        ("next", None, False, True),
    ]


def dashboard_rows(spark, *entries):
    """(payee, group, group id, cash account, transfer, amount)"""
    df = spark.createDataFrame(
        [(*e[:5], Decimal(e[5])) for e in entries],
        "payee_name string, budget_category_group string, budget_category_group_id string,"
        " account_is_cash boolean, transaction_is_transfer boolean, transaction_amount decimal(18,7)",
    )
    own = F.col("account_is_cash") & ~F.col("transaction_is_transfer")
    amount = F.col("transaction_amount")
    return df.withColumns(
        {
            "year_month": F.lit("2024-03-01").cast("date"),
            "income": F.when(own & (amount > 0), amount).otherwise(0).cast("decimal(18,7)"),
            "spending": F.when(own & (amount < 0), amount).otherwise(0).cast("decimal(18,7)"),
        }
    )


def test_cash_flow_edges(spark, rows):
    df = dashboard_rows(
        spark,
        ("Boss", "Unknown", None, True, False, 100),
        ("Shop", "Food", "g1", True, False, -30),
        ("Shop", "Rent", "g2", True, False, -20),
        ("Broker", "Invest", "gi", True, True, -15),
        ("Broker", "Invest", "gi", True, True, 5),
        ("Broker", "Invest", "gi", False, True, -99),
    )
    got = [(s, d, float(a)) for s, d, a in rows(marts.mart_cash_flow(df, "gi"), "src", "dest", "amount")]
    assert got == [
        ("Boss", "Income", 100),
        ("Income", "Savings", 50),
        ("Income", "Spending", 50),
        ("Savings", "Cash", 40),
        ("Savings", "Investment", 15),
        ("Spending", "Food", 30),
        ("Spending", "Rent", 20),
    ]


def test_cash_flow_from_savings(spark, rows):
    df = dashboard_rows(spark, ("Boss", "U", None, True, False, 10), ("Shop", "Food", "g1", True, False, -30))
    got = [(s, d, float(a)) for s, d, a in rows(marts.mart_cash_flow(df, "gi"), "src", "dest", "amount")]
    assert got == [
        ("Boss", "Income", 10),
        ("Income", "Spending", 10),
        ("Spending", "Food", 30),
        ("Spent Savings", "Spending", 20),
    ]


def test_cash_flow_reads_the_wide_table_once(spark):
    df = dashboard_rows(spark, ("Boss", "U", None, True, False, 10))
    text = marts.mart_cash_flow(df, "gi")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ExistingRDD") + text.count("LocalTableScan") == 1


def test_uncleared_marks_and_combinations(spark, rows):
    def transaction(ident, day, amount, status="uncleared"):
        return (ident, Decimal(amount), ident, status, True, False, "b", None, "a1", None, None, dt.date(2024, 3, day), TS1, None)

    unique = spark.createDataFrame(
        [transaction("l1", 1, -2), transaction("l2", 2, -2), transaction("l3", 3, -7), transaction("l4", 3, -8, "cleared")],
        TRANSACTION,
    )
    bank = spark.createDataFrame(
        [("b1", dt.date(2024, 3, 2), "a1", "bus", Decimal(-2)), ("b2", dt.date(2024, 3, 2), "a1", "shop", Decimal(-8)),
         ("b3", dt.date(2024, 2, 1), "a1", "before", Decimal(-7)), ("b4", dt.date(2024, 3, 2), "a2", "never", Decimal(-7))],
        "id string, date_id date, account_id string, description string, amount decimal(18,7)",
    )
    accounts = spark.createDataFrame(
        [("a1", dt.datetime(2024, 3, 1)), ("a2", None)], "id string, last_reconciled_at timestamp_ntz"
    )
    sides = marts.uncleared_sides(unique, bank, accounts)
    out = marts.mart_uncleared(*sides)
    assert rows(out, "transaction_description", "in_accounting", "in_vendor") == [
        ("l1", "✔️", "✔️"),
        ("l2", "✔️", "✔️"),
        ("l3", "✔️", "❌"),
        ("shop", "❌", "✔️"),
    ]
    counts = marts.uncleared_pair_counts(*sides)
    assert rows(counts, "amount", "n_ledger", "n_bank", "n_rows") == [
        (Decimal("-2.0000000"), 2, 1, 2), (Decimal("-7.0000000"), 1, 0, 1), (Decimal("-8.0000000"), 0, 1, 1),
    ]
    assert rows(marts.mart_uncleared(*sides, one_to_one=True), "transaction_description", "in_accounting", "in_vendor") == [
        ("l1", "✔️", "✔️"), ("l2", "✔️", "❌"), ("l3", "✔️", "❌"), ("shop", "❌", "✔️"),
    ]


def test_metrics_of_daily_sums_equal_those_of_the_dashboard(spark, rows, tmp_path):
    plain = adapters.with_lookups(spark, SF)
    store = TableStore(spark, str(tmp_path))
    summed = adapters.warehouse(spark, SF, store=store, stored=("mart_daily",))
    for name, spec in metrics.METRICS.items():
        if spec.source == "uncleared":
            continue
        changes = {"as_of": dt.date(2001, 7, 15), **({"time_range": None} if spec.time_range else {})}
        got = summed.metric(name, **changes)
        assert rows(got) == rows(plain.metric(name, **changes)), name
        assert all("/mart_daily/" in f for f in got.inputFiles()), name
    assert rows(summed.mart_daily.agg(F.sum("n_rows"))) == rows(plain.fact_accounting_transaction.agg(F.count("*")))


def test_uncleared_ledger_side_equals_whole_plus_split(spark, rows):
    """The short form used by the mart gives the rows of the long one."""
    w = adapters.warehouse(spark, SF)
    columns = ["id", "date_id", "account_id", "description", "amount"]
    short = w.int_unique_transaction.filter("clearing_status = 'uncleared'").withColumnRenamed("date", "date_id")
    long_rows = [(*r[:4], float(r[4])) for r in rows(w.uncleared_ledger, *columns)]
    assert sorted(long_rows) == sorted((*r[:4], float(r[4])) for r in rows(short, *columns))


def test_ledger_import_skips_entered_trips(spark, rows):
    legs = spark.createDataFrame(
        [("e1", "a1", "ref-1", True), ("e2", "a1", "ref-2", True), ("e3", None, "ref-3", True), ("e4", "a1", None, False)],
        "id string, account_id string, billing_ref string, is_billed boolean",
    ).withColumns(
        {"travel_date_id": F.lit("2024-03-01").cast("date"), "updated_at": F.lit(None).cast("timestamp_ntz"),
         "cost_sgd": F.lit("1.2345").cast("decimal(18,7)"), "source": F.lit("A"), "destination": F.lit("B")}
    )
    entered = spark.createDataFrame([("ref-1",), (None,)], "description string")
    out = marts.mart_ledger_import(legs, entered, "p9", "c9")
    assert rows(out, "split_memo", "amount", "memo", "split_id", "flag_color") == [
        ("ref-2", -1235, "A -> B", "public_transport:ref-2", None)
    ]
    assert len(out.first()["import_id"]) == 36


# --- wiring


def test_join_elimination_keeps_values(spark, rows):
    w = adapters.warehouse(spark, SF)
    columns = ["transaction_date", "transaction_amount", "income"]
    pruned = w.dashboard(columns)
    assert "Join" in pruned._jdf.queryExecution().analyzed().toString()
    assert rows(pruned, *columns) == rows(w.mart_dashboard, *columns)
    assert "supplier" not in pruned._jdf.queryExecution().executedPlan().toString()


def test_stored_warehouse_equals_lazy_one(spark, rows, tmp_path):
    lazy = adapters.warehouse(spark, SF)
    stored = adapters.warehouse(spark, SF, store=TableStore(spark, str(tmp_path)))
    stored.build()
    assert (tmp_path / "mart_uncleared").is_dir()
    for name in ("fact_accounting_transaction", "mart_cash_flow", "mart_uncleared", "mart_ledger_import", "dim_account"):
        columns = sorted(lazy.table(name).columns)
        assert rows(stored.table(name), *columns) == rows(lazy.table(name), *columns), name
    # metrics read only their columns of the stored mart
    text = stored.metric("income")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<transaction_date:date,income:decimal(18,7)>" in text


def test_building_needs_a_store(spark):
    with pytest.raises(ValueError, match="without a store"):
        adapters.warehouse(spark, SF).build()


def test_unknown_staged_input_is_refused():
    from tallyhouse.plans.warehouse import Staging

    with pytest.raises(TypeError, match="stg_nothing"):
        Staging(stg_nothing=None)


def test_time_ranges(spark):
    def bounds(spec):
        low, high = metrics.time_bounds(spec, dt.date(2024, 3, 31))
        return tuple(spark.range(1).select(low, high).first())

    assert bounds(metrics.CASH_FLOW) == (dt.date(2024, 2, 29), dt.date(2024, 3, 31))
    assert bounds(metrics.EXPENSES) == (dt.date(2023, 3, 31), dt.date(2024, 3, 31))
    assert bounds(metrics.ACTIVITY) == metrics.ACTIVITY_RANGE
    assert metrics.time_bounds(metrics.INCOME, dt.date(2024, 3, 31)) is None


def test_metric_filter_reaches_the_scan_of_a_stored_mart(spark, tmp_path):
    stored = adapters.warehouse(spark, SF, store=TableStore(spark, str(tmp_path)))
    text = stored.metric("activity")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(transaction_date,2020-03-01)" in text


def test_scratch_is_below_the_named_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert scratch_dir(spark, "x").startswith(root)


def test_metrics_are_the_mart_s_with_repeated_seed_rows(spark, rows):
    """A second map row of an account, or flag row of a payee, changes neither way of computing."""
    plain = adapters.warehouse(spark, SF)

    def doubled(**kwargs):
        w = adapters.warehouse(spark, SF, **kwargs)
        again = w.staging.account_map.withColumn("vendor_id", F.concat("vendor_id", F.lit("x")))
        w.staging.account_map = w.staging.account_map.unionByName(again)
        w.staging.payee_flag = w.staging.payee_flag.unionByName(w.staging.payee_flag)
        return w

    store = TableStore(spark, scratch_dir(spark, "doubled"))
    for name in ("net_worth", "cash", "income"):
        want = rows(plain.metric(name))
        assert rows(doubled().metric(name)) == want
        assert rows(doubled(store=store).metric(name)) == want


def test_activity_keeps_the_newest_days(spark, rows):
    days = [(dt.date(2024, 1, d), Decimal(d)) for d in range(1, 8)]
    df = spark.createDataFrame(days, "transaction_date date, transaction_amount decimal(18,7)")
    spec = metrics.MetricSpec(**{**vars(metrics.ACTIVITY), "time_range": None, "row_limit": 3, "rolling": 2})
    got = rows(metrics.run_metric(spec, df, dt.date(2024, 2, 1)), "period", "value")
    assert got == [(dt.date(2024, 1, d), d - 0.5) for d in (5, 6, 7)]


def test_a_time_range_in_the_options_counts(spark, rows):
    w = adapters.warehouse(spark, SF)
    day = (dt.date(1996, 1, 1), dt.date(1996, 3, 1))
    w.options = replace(w.options, metric_ranges={"income": day})
    assert [r[0] for r in rows(w.metric("income"), "period")] == [dt.date(1996, 1, 1), dt.date(1996, 2, 1)]


def test_versions_of_an_entity_share_the_exchange_that_deals_them_out(spark):
    sf = "/root/testdata/sf0.001"
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    staged, passed = adapters.staging(spark, sf), adapters.staging(spark, sf, passed=True)
    for name, newest in (("stg_transaction", facts.int_unique_transaction), ("stg_subtransaction", facts.int_unique_subtransaction)):
        assert exchanges(newest(getattr(staged, name))) == 1
        assert exchanges(getattr(passed, name)) == 0
        assert getattr(passed, name).exceptAll(getattr(staged, name)).count() == 0
    assert exchanges(passed.stg_trip_leg) == 0


def test_stored_models_are_written_with_entropy_coding(spark, tmp_path):
    stored = TableStore(spark, str(tmp_path)).write("t", spark.range(10))
    assert stored.count() == 10 and all(f.endswith(".zstd.parquet") for f in stored.inputFiles())
