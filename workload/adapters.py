"""Staged finance inputs derived from whole test tables.

Every adapter keeps all rows of its table. Entities come in two scrapes: all of them in
the first, some of them again, changed, in the second.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyhouse.functions.dates import month_start, ts_literal
from tallyhouse.functions.money import MONEY
from tallyhouse.functions.text import blank_to_null
from tallyhouse.plans.warehouse import LOOKUPS, READ_AGAIN, Options, Staging, Warehouse
from tallyhouse.session import scratch_dir
from tallyhouse.sources.lake import TableStore

AS_OF = dt.date(2001, 12, 31)
V1 = dt.datetime(2001, 11, 1)
V2 = dt.datetime(2001, 12, 30)
OPTIONS = Options(
    as_of=AS_OF,
    calendar_start=dt.date(1995, 1, 1),
    calendar_years_ahead=25,
    investment_group="g3",
    transport_payee="p1",
    transport_category="c1",
)


# Tables whose rows get hashed, exploded or sorted right after the scan, with their natural keys
NATURAL_KEYS = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_partkey"], "events": ["event_id"]}


def load(spark: SparkSession, sf_dir: str, table: str, dealt: bool = True) -> DataFrame:
    """A test table, one file or many.

    Large tables are dealt out by their natural key, however they are stored: a file can have few
    row groups, and Spark reuses the exchange where a query reads the table more than once. Rows that
    are only passed on or summed up need not be ``dealt``.
    """
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.repartition(*NATURAL_KEYS[table]) if dealt and table in NATURAL_KEYS else df


def _id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _dec(c: str) -> Column:
    """Doubles to exact cents before any arithmetic."""
    return F.col(c).cast("decimal(18,2)")


def _scraped(df: DataFrame, again: Column) -> DataFrame:
    """Each row once per scrape that reports it."""
    v1, v2 = ts_literal(V1), ts_literal(V2)
    return df.withColumn("scraped_on", F.explode(F.when(again, F.array(v1, v2)).otherwise(F.array(v1))))


def _first_scrape() -> Column:
    return F.col("scraped_on") == ts_literal(V1)


def _versioned(name: Column) -> Column:
    return F.when(_first_scrape(), F.concat(name, F.lit(" (old)"))).otherwise(name)


def stg_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    return _scraped(load(spark, sf_dir, "region"), key % 2 == 0).select(
        _id("b", key).alias("id"),
        _versioned(F.col("r_name")).alias("name"),
        F.col("scraped_on").alias("modified_at"),
        F.lit("SGD").alias("currency_code"),
        F.lit("$").alias("currency_symbol"),
        "scraped_on",
    )


def stg_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    kind = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "checking")
        .when(F.col("c_mktsegment") == "BUILDING", "savings")
        .when(F.col("c_mktsegment") == "FURNITURE", "cash")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "creditCard")
        .otherwise("otherAsset")
    )
    reconciled = F.date_add(F.lit("1998-01-01").cast("date"), (key % 365).cast("int"))
    return _scraped(load(spark, sf_dir, "customer"), key % 5 != 0).select(
        _id("a", key).alias("id"),
        _versioned(F.col("c_name")).alias("name"),
        kind.alias("type"),
        (F.col("c_mktsegment") != "MACHINERY").alias("on_budget"),
        (F.col("c_acctbal") < 0).alias("is_closed"),
        F.lit(False).alias("is_deleted"),
        _id("p", key % 10).alias("payee_id"),
        F.when(key % 50 != 0, reconciled.cast("timestamp_ntz")).alias("last_reconciled_at"),
        "scraped_on",
    )


def account_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other account is mapped to a bank account, half of them at the known bank."""
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        _id("a", key * 2).alias("budget_account_id"),
        F.when(key % 2 == 0, "UOB").otherwise("OTHER").alias("vendor"),
        _id("v", key * 2).alias("vendor_id"),
    )


def stg_payee(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _scraped(load(spark, sf_dir, "supplier"), key % 5 == 0).select(
        _id("p", key).alias("id"),
        _versioned(F.col("s_name")).alias("name"),
        F.when(key % 10 == 0, _id("a", key)).alias("transfer_account_id"),
        "scraped_on",
    )


def payee_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return load(spark, sf_dir, "supplier").select(
        _id("p", key * 3).alias("payee_id"),
        F.col("s_name").alias("payee_name"),
        (key % 2 == 0).alias("is_unaccounted"),
        (key % 2 == 1).alias("is_passive"),
    )


def stg_budget_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("l_partkey") % 50).alias("n")
    month = month_start(F.to_date("l_shipdate")).alias("budget_month")
    sums = (
        load(spark, sf_dir, "lineitem", dealt=False)
        .groupBy(n, month)
        .agg(F.sum(_dec("l_extendedprice")).cast(MONEY).alias("budget_amount"))
    )
    n = F.col("n")
    goal = (
        F.when(n % 4 == 1, "Target Category Balance by Date")
        .when(n % 4 == 2, "Monthly Funding")
        .when(n % 4 == 3, "Plan Your Spending")
    )
    return _scraped(sums, n % 3 == 0).select(
        _id("c", n).alias("id"),
        _versioned(_id("Category ", n)).alias("name"),
        F.lit("b0").alias("budget_id"),
        _id("g", n % 6).alias("category_group_id"),
        "budget_amount",
        "budget_month",
        goal.alias("goal_type"),
        F.when(goal.isNull(), F.lit(0)).otherwise(n * 100).cast(MONEY).alias("goal_amount"),
        F.when(n % 4 == 1, F.last_day("budget_month")).alias("goal_due"),
        F.lit(False).alias("is_deleted"),
        "scraped_on",
    )


def stg_category_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("r_regionkey"), F.col("r_name")
    label = F.when(key < 3, F.concat(F.lit("Expenses: "), name)).otherwise(name)
    return _scraped(load(spark, sf_dir, "region"), key % 2 == 1).select(
        _id("g", key).alias("id"),
        _versioned(label).alias("name"),
        F.lit(False).alias("is_deleted"),
        "scraped_on",
    )


def _by_id(df: DataFrame, entity: Column, by_id: bool) -> DataFrame:
    """Adds ``id``, and deals rows out by it: their versions then stand together, without a second exchange."""
    keyed = df.withColumn("id", entity)
    return keyed.repartition("id") if by_id else keyed


def stg_transaction(spark: SparkSession, sf_dir: str, dealt: bool = True, by_id: bool = False) -> DataFrame:
    return transactions(_by_id(load(spark, sf_dir, "orders", dealt and not by_id), transaction_id(), by_id))


def transaction_id() -> Column:
    return _id("t", F.col("o_orderkey"))


def transactions(orders: DataFrame, *kept: str) -> DataFrame:
    """Every order (with its ``id``) as a transaction; ``kept`` columns go along."""
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    price = _dec("o_totalprice").cast(MONEY)
    status = (
        F.when(F.col("o_orderstatus") == "F", "cleared")
        .when(F.col("o_orderstatus") == "O", "uncleared")
        .otherwise("reconciled")
    )
    return _scraped(orders, key % 5 == 0).select(
        *kept,
        "id",
        F.when(key % 3 == 0, price).otherwise(-price).cast(MONEY).alias("amount"),
        _id("ref-", key % 1000).alias("description"),
        status.alias("clearing_status"),
        (key % 7 != 0).alias("is_approved"),
        (~_first_scrape() & (key % 35 == 0)).alias("is_deleted"),
        F.lit("b0").alias("budget_id"),
        F.when(key % 4 != 0, _id("c", owner % 50)).alias("category_id"),
        _id("a", owner).alias("account_id"),
        _id("p", key % 10).alias("payee_id"),
        F.when(key % 11 == 0, _id("a", owner % 100)).alias("transfer_account_id"),
        F.to_date("o_orderdate").alias("date"),
        "scraped_on",
        F.when(key % 20 == 0, _id("m", key)).alias("matched_transaction_id"),
    )


def stg_subtransaction(spark: SparkSession, sf_dir: str, dealt: bool = True, by_id: bool = False) -> DataFrame:
    """All line items, as parts of every fourth order."""
    return parts(_by_id(load(spark, sf_dir, "lineitem", dealt and not by_id), part_id(), by_id))


def part_id() -> Column:
    shipped = F.to_date("l_shipdate").cast("string")
    return F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped))


def part_owner() -> Column:
    """Key of the order that a line item is a part of."""
    return F.col("l_orderkey") - F.col("l_orderkey") % 4


def parts(lines: DataFrame, *kept: str) -> DataFrame:
    """Every line item (with its ``id``) as a part; ``kept`` columns go along."""
    parent, line = part_owner(), F.col("l_linenumber")
    merged = (parent % 20 == 0) & (line % 2 == 0)
    return _scraped(lines, F.col("l_partkey") % 10 == 0).select(
        *kept,
        "id",
        F.when(merged, _id("m", parent)).otherwise(_id("t", parent)).alias("super_id"),
        F.when(line % 3 == 0, _id("line-", line)).alias("description"),
        _id("c", F.col("l_partkey") % 50).alias("category_id"),
        F.lit(None).cast("string").alias("payee_id"),
        F.lit(None).cast("string").alias("transfer_account_id"),
        (line == 7).alias("is_deleted"),
        (-_dec("l_extendedprice")).cast(MONEY).alias("amount"),
        "scraped_on",
    )


def stg_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a bank row of a mapped account, with the account's end-of-day balance.

    Balances run over day totals, so no window holds more rows than there are days.
    """
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    price = _dec("o_totalprice").cast(MONEY)
    rows = load(spark, sf_dir, "orders", dealt=False).select(
        "o_orderkey",
        _id("v", owner - owner % 4).alias("account_no"),
        F.to_date("o_orderdate").alias("transacted_on"),
        F.col("o_orderpriority").alias("description"),
        F.when(key % 3 == 0, price).otherwise(0).cast(MONEY).alias("deposit"),
        F.when(key % 3 == 0, 0).otherwise(price).cast(MONEY).alias("withdrawal"),
    )
    days = rows.groupBy("account_no", "transacted_on").agg(
        F.sum(F.col("deposit") - F.col("withdrawal")).alias("moved")
    )
    so_far = (
        Window.partitionBy("account_no")
        .orderBy("transacted_on")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    balances = days.select(
        "account_no", "transacted_on", F.sum("moved").over(so_far).cast(MONEY).alias("balance")
    )
    return _scraped(rows.join(balances, ["account_no", "transacted_on"]), key % 5 == 0).select(
        "transacted_on",
        "description",
        "account_no",
        F.concat(F.lit("Account "), "account_no").alias("name"),
        "deposit",
        "withdrawal",
        "balance",
        F.lit("SGD").alias("currency_code"),
        month_start("transacted_on").cast("timestamp_ntz").alias("statement_begin"),
        F.last_day("transacted_on").cast("timestamp_ntz").alias("statement_end"),
        "scraped_on",
    )


def stg_trip_leg(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    return trip_legs(load(spark, sf_dir, "events", dealt))


def trip_legs(events: DataFrame) -> DataFrame:
    """Every event as a trip leg; fares of repeated scrapes are corrected to whole dollars."""
    key, user = F.col("event_id"), F.col("user_id")
    fare = _dec("value")
    return _scraped(events, key % 5 == 0).select(
        _id("e", key).alias("trip_id"),
        blank_to_null(F.when(key % 3 == 0, _id("ref-", key % 1500)).otherwise("")).alias("posting_ref"),
        F.col("ts").alias("traveled_on"),
        F.when(_first_scrape(), fare).otherwise(F.round(fare, 0)).cast(MONEY).alias("cost_sgd"),
        _id("Stop ", user).alias("source"),
        _id("Stop ", key % 40).alias("destination"),
        F.when(key % 2 == 0, "Rail").otherwise("Bus").alias("transport_mode"),
        _id("k", user % 20).alias("card_id"),
        "scraped_on",
    )


def stg_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("user_id") % 20
    return (
        _scraped(load(spark, sf_dir, "events", dealt=False), n % 4 == 0)
        .select(_id("k", n).alias("id"), _versioned(_id("Card ", n)).alias("name"), "scraped_on")
        .distinct()
    )


def card_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("user_id") % 20
    return (
        load(spark, sf_dir, "events", dealt=False)
        .select(
            _id("k", n).alias("bank_card_id"),
            F.lit("UOB").alias("vendor"),
            _id("v", n * 4).alias("vendor_id"),
        )
        .distinct()
    )


def staging(spark: SparkSession, sf_dir: str, passed: bool = False) -> Staging:
    """The staged inputs; ``passed`` if their rows are only passed over, as by checks of rows, and need no dealing."""
    large = {"stg_transaction": {"by_id": True}, "stg_subtransaction": {"by_id": True}, "stg_trip_leg": {}}
    if passed:
        large = {name: {"dealt": False} for name in large}
    makers = (
        stg_budget,
        stg_budget_category,
        stg_category_group,
        stg_account,
        stg_payee,
        stg_transaction,
        stg_subtransaction,
        stg_statement,
        stg_card,
        stg_trip_leg,
        payee_flag,
        account_map,
        card_map,
    )
    return Staging(**{make.__name__: partial(make, spark, sf_dir, **large.get(make.__name__, {})) for make in makers})


def warehouse(spark: SparkSession, sf_dir: str, **kwargs) -> Warehouse:
    return Warehouse(spark, staging(spark, sf_dir), OPTIONS, **kwargs)


def with_lookups(spark: SparkSession, sf_dir: str, also: Collection[str] = ()) -> Warehouse:
    """A warehouse whose lookup tables, and models read several times, are written before use."""
    store = TableStore(spark, scratch_dir(spark, "models"))
    return warehouse(spark, sf_dir, store=store, stored=LOOKUPS | READ_AGAIN | set(also))
