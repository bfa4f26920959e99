"""Registered queries, each over whole test tables, with their SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.dates import date_literal, presumed_deleted
from tallyhouse.functions.keys import import_id, surrogate_key
from tallyhouse.functions.money import MONEY_SUM, to_int
from tallyhouse.operators import calendar, dedupe, joins, quality, series, unnest
from tallyhouse.plans import checks, facts, marts, metrics, staging
from tallyhouse.plans.warehouse import LOOKUPS, Staging, Warehouse
from tallyhouse.session import move_files, scratch_dir
from tallyhouse.sources import budget, incremental, journeys, lake, seeds, statements, versioned
from tallyhouse.streaming import snapshots
from workload import adapters, oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

METRIC_DAY = dt.date(2001, 7, 15)
ACTIVITY_RANGE = (dt.date(1996, 1, 1), dt.date(1999, 12, 31))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = oracle.compose(sql)
        return run

    return register


def _register(name: str, run: Query, sql: str) -> None:
    QUERIES[name] = run
    SQL[name] = oracle.compose(sql)


# --- models -----------------------------------------------------------------

# Both sides of the reconciliation join are read for its pairs and for its unmatched rows. The
# ledger side comes straight from one shuffle that Spark reuses; the bank side is a long plan.
RECONCILED = ("fact_vendor_transaction",)
_READ_AGAIN = {"mart_uncleared": RECONCILED}
_MODELS = {
    "latest_transaction_live": "int_unique_transaction",
    "budget_category_unique": "int_unique_budget_category",
    "bank_statement_enriched": "int_enriched_bank_statement",
    "dim_account": "dim_account",
    "dim_bank_card": "dim_bank_card",
    "dim_budget": "dim_budget",
    "dim_payee": "dim_payee",
    "dim_budget_category_scd2": "dim_budget_category",
    "fact_accounting_transaction": "fact_accounting_transaction",
    "fact_monthly_budget": "fact_monthly_budget",
    "fact_vendor_transaction": "fact_vendor_transaction",
    "fact_bank_statement": "fact_bank_statement",
    "fact_trip_leg": "fact_trip_leg",
    "mart_dashboard": "mart_dashboard",
    "mart_cash_flow": "mart_cash_flow",
    "mart_uncleared": "mart_uncleared",
    "mart_ledger_sink": "mart_ledger_import",
    "uncleared_ledger": "uncleared_ledger",
}


def _model_table(spark: SparkSession, sf: str, model: str) -> DataFrame:
    """Facts and marts are joined with stored lookups; lookups themselves are only planned."""
    if model in LOOKUPS or model.startswith("dim_"):
        return adapters.warehouse(spark, sf).table(model)
    return adapters.with_lookups(spark, sf, _READ_AGAIN.get(model, ())).table(model)


for _name, _model in _MODELS.items():
    _register(_name, partial(_model_table, model=_model), f"select * from {_model}")


# --- metrics ----------------------------------------------------------------


_METRIC_SQL: dict[str, tuple[str, dt.date | None, dict, str]] = {}


def _metric(name: str, metric: str, sql: str, as_of: dt.date | None = None, **changes) -> None:
    if metrics.METRICS[metric].source != "uncleared":
        _METRIC_SQL[name] = metric, as_of, changes, sql
    also = RECONCILED if metrics.METRICS[metric].source == "uncleared" else ()
    _register(
        name, lambda spark, sf: adapters.with_lookups(spark, sf, also).metric(metric, as_of, **changes), sql
    )


def _month_sums(column: str, time: str = "transaction_date", where: str = "true", name: str = "value") -> str:
    return (
        f"select cast(date_trunc('month', {time}) as date) as period, cast(sum({column}) as {oracle.SUM}) as {name}"
        f" from mart_dashboard where {where} group by 1"
    )


def _worth(where: str) -> str:
    return f"""
        select period, value,
               round(cast(value - lag(value) over (order by period) as double)
                     / nullif(cast(abs(lag(value) over (order by period)) as double), 0), 6) as change
        from (select period, cast(sum(moved) over (order by period rows unbounded preceding) as {oracle.SUM}) as value
              from ({_month_sums('transaction_amount', where=where, name='moved')}))"""


_metric("metric_net_worth", "net_worth", _worth("true"))
_metric("metric_cash", "cash", _worth("account_is_cash"))
_metric("metric_income", "income", _month_sums("income"))
_metric("metric_spending", "spending", _month_sums("spending"))
_metric("metric_passive", "passive_income", _month_sums("transaction_amount", "year_month", "is_passive"))
_metric("metric_unaccounted", "unaccounted_spending", _month_sums("spending", where="is_unaccounted"))
_metric(
    "metric_income_headline",
    "income",
    f"select * from ({_month_sums('income')}) order by period desc limit 1",
    headline=True,
)
_metric(
    "metric_saving_rate",
    "saving_rate",
    """select cast(date_trunc('month', year_month) as date) as period,
              round(cast(sum(cash_amount) as double) / nullif(cast(sum(income) as double), 0), 6) as value
       from mart_dashboard group by 1""",
)
_metric(
    "metric_fi_progress",
    "fi_progress",
    f"""select cast(sum(transaction_amount) as {oracle.SUM}) as value,
               round(cast(sum(transaction_amount) as double) / 1200000, 6) as progress
        from mart_dashboard""",
)
_metric(
    "metric_activity_ma30",
    "activity",
    """select period, round(cast(sum(value) over w as double) / count(value) over w, 4) as value
       from (select transaction_date as period, sum(transaction_amount) as value from mart_dashboard
             where transaction_date >= date '1996-01-01' and transaction_date < date '1999-12-31' group by 1)
       window w as (order by period rows between 29 preceding and current row)""",
    time_range=ACTIVITY_RANGE,
)
_metric(
    "metric_expenses",
    "expenses",
    f"""select cast(date_trunc('month', transaction_date) as date) as period, budget_category,
               cast(abs(sum(transaction_amount)) as {oracle.SUM}) as value
        from mart_dashboard
        where budget_is_expense and transaction_date >= date '2000-07-15' and transaction_date < date '2001-07-15'
        group by 1, 2 order by value desc, period, budget_category limit 10000""",
    as_of=METRIC_DAY,
)
_metric(
    "metric_cash_flow_top",
    "cash_flow_top",
    f"""select src, dest, cast(sum(amount) as {oracle.SUM}) as value from mart_cash_flow
        where year_month >= date '2001-06-15' and year_month < date '2001-07-15'
        group by 1, 2 order by value desc, src, dest limit 10000""",
    as_of=METRIC_DAY,
)
_metric(
    "metric_uncleared_balance",
    "uncleared_balance",
    f"select cast(sum(transaction_amount) as {oracle.SUM}) as value from mart_uncleared",
)
_metric("metric_uncleared_count", "uncleared_count", "select count(*) as value from mart_uncleared")


def _labels(columns: list[str]) -> list[str]:
    """Columns that tell a metric's rows apart, beside the period."""
    return [c for c in ("budget_category", "src", "dest") if c in columns]


def _all_metrics_sql() -> str:
    labels = {"expenses": "budget_category", "cash_flow_top": "src || ' > ' || dest"}
    periods = ("fi_progress", "cash_flow_top")
    return " union all ".join(
        f"select '{name}' as metric, {'null' if metric in periods else 'period'}::date as period,"
        f" {labels.get(metric, 'null')}::varchar as label, value::double as value from ({sql})"
        for name, (metric, _, _, sql) in _METRIC_SQL.items()
    )


@query(_all_metrics_sql())
def dashboard_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """All metrics of the dashboard and its cash flows, from one stored aggregate of the transactions."""
    house = adapters.with_lookups(spark, sf, ("mart_daily",))
    out = []
    for name, (metric, as_of, changes, _) in _METRIC_SQL.items():
        rows = house.metric(metric, as_of, **changes)
        period = F.col("period") if "period" in rows.columns else F.lit(None)
        labels = _labels(rows.columns)
        label = F.concat_ws(" > ", *labels) if labels else F.lit(None).cast("string")
        out.append(rows.select(F.lit(name).alias("metric"), period.cast("date").alias("period"), label.alias("label"), F.col("value").cast("double")))
    return reduce(DataFrame.unionAll, out)


@query(
    """select account_id, amount, n_ledger, n_bank,
              case when n_ledger > 0 and n_bank > 0 then n_ledger * n_bank else n_ledger + n_bank end as n_rows
       from uncleared_counts"""
)
def uncleared_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How often the uncleared mart lists an account and amount."""
    return adapters.with_lookups(spark, sf, RECONCILED).uncleared_pair_counts


@query(
    """select coalesce(l.date_id, b.date_id) as transaction_date,
              coalesce(l.description, b.description) as transaction_description,
              coalesce(l.amount, b.amount) as transaction_amount,
              if(l.id is null, '❌', '✔️') as in_accounting, if(b.id is null, '❌', '✔️') as in_vendor
       from (select * from uncleared_entries where own) l
       full join (select * from uncleared_entries where not own) b using (account_id, amount, place)"""
)
def uncleared_one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    """Uncleared entries, each matched at most once."""
    return adapters.with_lookups(spark, sf, RECONCILED).uncleared_one_to_one


@query(
    """select transaction_date, transaction_description, transaction_amount, in_accounting, in_vendor
       from mart_uncleared order by all limit 1000"""
)
def uncleared_rows(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.with_lookups(spark, sf, RECONCILED).uncleared_rows()


# --- operators --------------------------------------------------------------


@query("select * from own_account")
def latest_account(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_per_key(adapters.stg_account(spark, sf), ["id"], ties=["name"])


@query(
    """select o_custkey, o_orderkey, o_orderdate, o_totalprice from (
           select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as nth from orders
       ) where nth = 1"""
)
def earliest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = adapters.load(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return dedupe.earliest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    """select p_partkey as id, p_name as name, p_brand, p_type, p_size, coalesce(p_size > 25, false) as is_large
       from part"""
)
def star_except(spark: SparkSession, sf: str) -> DataFrame:
    part = dedupe.without(adapters.load(spark, sf, "part"), "p_retailprice")
    return part.withColumnsRenamed({"p_partkey": "id", "p_name": "name"}).select(
        "*", F.coalesce(F.col("p_size") > 25, F.lit(False)).alias("is_large")
    )


@query(
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               {oracle.key('l_orderkey', 'l_linenumber', 'nullif(l_returnflag, chr(78))')} as row_key,
               left(sha256('pvd' || l_orderkey || '/' || l_linenumber), 36) as import_id,
               cast(round(cast(l_quantity as decimal(18,2)) * 1.5) as integer) as rounded
        from lineitem"""
)
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    label = F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    return adapters.load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        surrogate_key("l_orderkey", "l_linenumber", flag).alias("row_key"),
        import_id(label).alias("import_id"),
        to_int(F.col("l_quantity").cast("decimal(18,2)") * F.lit(1.5).cast("decimal(2,1)")).alias("rounded"),
    )


@query(
    oracle.calendar(
        """select cast(unnest(generate_series(low, high, interval 1 day)) as date) as d
           from (select min(cast(o_orderdate as date)) as low,
                        cast(max(o_orderdate) + interval 20 year - interval 1 day as date) as high from orders)"""
    )
)
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar from the first order to 20 years after the last."""
    day = F.to_date("o_orderdate")
    bounds = adapters.load(spark, sf, "orders").agg(F.min(day).alias("low"), F.max(day).alias("high"))
    days = calendar.day_spine(bounds, F.col("low"), F.add_months("high", 240))
    return calendar.calendar(days, date_literal(adapters.AS_OF))


@query(
    """select t.id, t.matched_transaction_id, t.amount, p.id as part_id, p.super_id as part_super_id,
              p.amount as part_amount
       from int_unique_transaction t left join part_owner p on p.owner = t.id"""
)
def or_key_join(spark: SparkSession, sf: str) -> DataFrame:
    w = adapters.with_lookups(spark, sf)
    transactions, parts = w.int_unique_transaction, w.int_unique_subtransaction
    return joins.either_key_left_join(
        transactions.select("id", "matched_transaction_id", "amount"),
        parts.select("id", "super_id", "amount"),
        "id",
        "matched_transaction_id",
        "super_id",
        prefix="part_",
    )


@query(
    f"""select t.id, t.date as date_id, t.account_id, t.description, t.clearing_status,
               cast(sum(t.amount) as {oracle.SUM}) as amount
        from int_unique_transaction t
        where exists (select 1 from part_owner where owner = t.id)
        group by all"""
)
def split_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Semi join of transactions with the parents of parts, one row each."""
    w = adapters.with_lookups(spark, sf)
    return marts.split_totals(w.int_unique_transaction, w.int_split_transaction)


@query(
    f"""select c_custkey as customer, n_orders, spent, largest_share from (
            select o_custkey as c_custkey, count(*) as n_orders,
                   cast(sum(cast(o_totalprice as decimal(18,2))) as {oracle.SUM}) as spent,
                   round(cast(max(cast(o_totalprice as decimal(18,2))) as double)
                         / cast(sum(cast(o_totalprice as decimal(18,2))) as double), 6) as largest_share
            from orders group by 1)
        order by spent desc, customer limit 50"""
)
def top_spenders(spark: SparkSession, sf: str) -> DataFrame:
    """Top groups by a metric."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    spent = (
        adapters.load(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("customer"))
        .agg(
            F.count("*").alias("n_orders"),
            F.sum(price).cast(MONEY_SUM).alias("spent"),
            F.round(F.try_divide(F.max(price).cast("double"), F.sum(price).cast("double")), 6).alias(
                "largest_share"
            ),
        )
    )
    return series.top_k(spent, "spent", 50, ["customer"])


@query(
    f"""select trip_id, scraped_on, date_diff('day', cast(scraped_on as date), date '2001-12-31') > 2 as is_deleted
        from stg_trip_leg"""
)
def snapshot_age(spark: SparkSession, sf: str) -> DataFrame:
    """Entities that newer snapshots no longer report count as deleted."""
    legs = adapters.stg_trip_leg(spark, sf)
    return legs.select(
        "trip_id", "scraped_on", presumed_deleted("scraped_on", adapters.AS_OF).alias("is_deleted")
    )


# --- sources ----------------------------------------------------------------


@query(
    """select event_id, user_id, 0 as position, cast(json_extract(props, '$.k') as bigint) as k from events
       union all
       select event_id, user_id, 1, cast(json_extract(props, '$.k') as bigint) + 1 from events"""
)
def json_props_unnest(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text to a struct, and an array of structs to rows with parent fields carried down."""
    events = adapters.load(spark, sf, "events").withColumn("doc", F.from_json("props", "k bigint"))
    entries = F.array(
        F.struct(F.lit(0).alias("position"), F.col("doc.k").alias("k")),
        F.struct(F.lit(1).alias("position"), (F.col("doc.k") + 1).alias("k")),
    )
    keep = {"event_id": F.col("event_id"), "user_id": F.col("user_id")}
    return unnest.unnest(events, entries, keep)


def _through_documents(
    spark: SparkSession, rows: DataFrame, array: str | None, entry: Column | None, stage: Callable
) -> DataFrame:
    """Write each row as a JSON budget document of its scrape day, read the lake back and stage it."""
    c = F.col
    if array is None:  # the budget's own fields
        fields = [
            c("id"),
            c("name"),
            c("modified_at").cast("string").alias("last_modified_on"),
            F.struct(c("currency_code").alias("iso_code"), "currency_symbol").alias("currency_format"),
        ]
    else:
        fields = [F.lit("b0").alias("id"), F.array(entry).alias(array)]
    document = F.struct(F.struct(*fields).alias("budget"), F.lit(1).cast("bigint").alias("server_knowledge"))
    root = scratch_dir(spark, "budget")
    documents = rows.select(document.alias("data"), c("scraped_on").cast("date").alias("date"))
    documents.write.partitionBy("date").json(f"{root}/by={lake.BUDGET_SOURCE}")
    arrays = [array] if array else []
    return stage(budget.read_budget(spark, root, *arrays, lines=True))


def _milliunits(name: str) -> Column:
    return (F.col(name) * 1000).cast("bigint")


@query("select * from stg_budget")
def stg_budget(spark: SparkSession, sf: str) -> DataFrame:
    return _through_documents(spark, adapters.stg_budget(spark, sf), None, None, staging.stg_budget)


@query("select * from stg_account")
def stg_account(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    entry = F.struct(
        "id",
        "name",
        "type",
        "on_budget",
        c("is_closed").alias("closed"),
        c("is_deleted").alias("deleted"),
        c("payee_id").alias("transfer_payee_id"),
        c("last_reconciled_at").cast("string").alias("last_reconciled_at"),
    )
    return _through_documents(spark, adapters.stg_account(spark, sf), "accounts", entry, staging.stg_account)


@query("select * from stg_payee")
def stg_payee(spark: SparkSession, sf: str) -> DataFrame:
    entry = F.struct("id", "name", "transfer_account_id", F.lit(False).alias("deleted"))
    return _through_documents(spark, adapters.stg_payee(spark, sf), "payees", entry, staging.stg_payee)


@query("select * from stg_category_group")
def stg_category_group(spark: SparkSession, sf: str) -> DataFrame:
    entry = F.struct("id", "name", F.lit(False).alias("hidden"), F.col("is_deleted").alias("deleted"))
    rows = adapters.stg_category_group(spark, sf)
    return _through_documents(spark, rows, "category_groups", entry, staging.stg_category_group)


def _category_entry() -> Column:
    code = F.lit(None).cast("string")
    for key, label in staging.GOAL_LABELS.items():
        code = F.when(F.col("goal_type") == label, key).otherwise(code)
    return F.struct(
        "id",
        "category_group_id",
        "name",
        _milliunits("budget_amount").alias("budgeted"),
        code.alias("goal_type"),
        _milliunits("goal_amount").alias("goal_target"),
        F.col("goal_due").cast("string").alias("goal_target_month"),
        F.col("is_deleted").alias("deleted"),
    )


@query("select * from stg_budget_category")
def stg_budget_category(spark: SparkSession, sf: str) -> DataFrame:
    """Categories below months, two levels deep, with goal codes turned into labels."""
    month = F.struct(F.col("budget_month").cast("string").alias("month"), F.array(_category_entry()).alias("categories"))
    rows = adapters.stg_budget_category(spark, sf)
    return _through_documents(spark, rows, "months", month, staging.stg_budget_category)


def _transaction_entry() -> Column:
    c = F.col
    return F.struct(
        "id",
        c("date").cast("string").alias("date"),
        _milliunits("amount").alias("amount"),
        c("description").alias("memo"),
        c("clearing_status").alias("cleared"),
        c("is_approved").alias("approved"),
        "account_id",
        "payee_id",
        "category_id",
        "transfer_account_id",
        "matched_transaction_id",
        c("is_deleted").alias("deleted"),
    )


@query("select * from stg_transaction")
def stg_transaction(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.stg_transaction(spark, sf)
    return _through_documents(spark, rows, "transactions", _transaction_entry(), staging.stg_transaction)


def _subtransaction_entry() -> Column:
    c = F.col
    return F.struct(
        "id",
        c("super_id").alias("transaction_id"),
        _milliunits("amount").alias("amount"),
        c("description").alias("memo"),
        "payee_id",
        "category_id",
        "transfer_account_id",
        c("is_deleted").alias("deleted"),
    )


@query("select * from stg_subtransaction")
def stg_subtransaction(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.stg_subtransaction(spark, sf)
    return _through_documents(spark, rows, "subtransactions", _subtransaction_entry(), staging.stg_subtransaction)


DOCUMENT_ORDERS = 32  # order keys that share a document
FILE_DOCUMENTS = 2000  # a compressed file is read by one task, so its documents are bounded


def _write_documents(text: DataFrame, root: str, *above: str) -> None:
    """Documents (value, date), one per line, as compressed files of day folders: text takes several times as much."""
    writer = text.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCUMENTS)
    writer.partitionBy(*above, "date").text(root if above else f"{root}/by={lake.BUDGET_SOURCE}")


def _order_documents(spark: SparkSession, sf: str) -> str:
    """The documents of ``_order_texts``, written."""
    root = scratch_dir(spark, "budget")
    _write_documents(_order_texts(spark, sf), root)
    return root


def _order_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents (value, date) of two budgets, each with the transactions and parts of some orders, one per line.

    Arrays hold none, one or many entries; of odd documents an empty one is left out. A document is
    bounded by its order keys. Orders and line items are dealt out by document as they are read, before
    they are turned into entries of many more bytes: a union keeps that, so gathering takes no exchange.
    """
    c = F.col
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def rows(table: str, order: Column, entity: Column, made: Callable[..., DataFrame], entry: Column, name: str) -> DataFrame:
        group = F.floor(F.abs(order) / DOCUMENT_ORDERS)
        read = adapters.load(spark, sf, table, dealt=False).withColumn("g", group).repartition(n, "g")
        return made(read.withColumn("id", entity), "g").select("g", "scraped_on", entry.alias(name))

    entries = rows("orders", c("o_orderkey"), adapters.transaction_id(), adapters.transactions, _transaction_entry(), "t").unionByName(
        rows("lineitem", adapters.part_owner(), adapters.part_id(), adapters.parts, _subtransaction_entry(), "p"), allowMissingColumns=True
    )
    arrays = entries.groupBy("g", "scraped_on").agg(
        F.collect_list("t").alias("transactions"), F.collect_list("p").alias("subtransactions")
    )
    shown = [F.when((F.size(a) > 0) | (c("g") % 2 == 0), c(a)).alias(a) for a in ("transactions", "subtransactions")]
    fields = [F.concat(F.lit("b"), c("g") % 2).alias("id"), *shown]
    document = F.struct(F.struct(*fields).alias("budget"), c("g").alias("server_knowledge"))
    text = F.to_json(F.struct(document.alias("data"))).alias("value")
    return arrays.select(text, c("scraped_on").cast("date").alias("date"))


_DOCUMENTS = """
    documents as (
        select g, scraped_on, sum(transactions)::bigint as transactions from (
            select cast(substr(id, 2) as bigint) // 32 as g, scraped_on, 1 as transactions from stg_transaction
            union all select cast(substr(super_id, 2) as bigint) // 32, scraped_on, 0 from stg_subtransaction)
        group by all)"""


@query(
    f"""select * from (with {_DOCUMENTS}
        select 'sound' as kind, null::varchar as detail, count(*) as n_documents, sum(transactions)::bigint as n_transactions
        from documents where g % 7 not in (0, 3, 4)
        union all
        select 'quarantine', if(g % 7 = 3, 'has no budget id', 'does not parse'), count(*), null
        from documents where g % 7 in (0, 3, 4) group by 2
        union all
        select 'unknown field', if(g % 7 = 2, 'colour', 'transactions.weight'), count(*), null
        from documents where g % 7 = 2 or (g % 7 = 5 and transactions > 0) group by 2)"""
)
def budget_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of which some are cut off, drifted in type, belong to no budget, or hold new fields."""
    raw = budget.read_raw(spark, _order_documents(spark, sf), lines=True)
    g = F.regexp_extract("value", '"server_knowledge":([0-9]+)', 1).cast("bigint") % 7
    told = lambda pattern, text: F.regexp_replace("value", pattern, text)
    value = (
        F.when(g == 0, F.expr("substring(value, 1, length(value) - 10)"))
        .when(g == 2, told('"budget":[{]', '"budget":{"colour":"red",'))
        .when(g == 3, told('"budget":[{]"id":"b[01]"', '"budget":{"name":"x"'))
        .when(g == 4, told('"server_knowledge":', '"server_knowledge":"new"+'.replace("+", ',"x":')))
        .when(g == 5, told('"transactions":\\[[{]', '"transactions":[{"weight":1,'))
        .otherwise(F.col("value"))
    )
    root = scratch_dir(spark, "drifted")
    _write_documents(raw.select(value.alias("value"), "date"), root)
    raw = budget.read_raw(spark, root, lines=True)
    documents = budget.checked(raw, "transactions", "subtransactions")
    nothing = F.lit(None).cast("bigint").alias("n_transactions")
    size = F.greatest(F.size("data.budget.transactions"), F.lit(0))
    sound = budget.sound(documents).agg(
        F.lit("sound").alias("kind"), F.lit(None).cast("string").alias("detail"),
        F.count("*").alias("n_documents"), F.sum(size).cast("bigint").alias("n_transactions"),
    )
    aside = budget.quarantine(documents).groupBy(F.lit("quarantine").alias("kind"), F.col("reason").alias("detail"))
    unknown = budget.unknown_fields(raw, "transactions", "subtransactions")
    return (
        sound.unionAll(aside.agg(F.count("*").alias("n_documents"), nothing))
        .unionAll(unknown.select(F.lit("unknown field"), "field", "n_documents", nothing))
    )


@query(
    f"""select 'transaction' as kind, id, amount, description, scraped_on from ({oracle.latest("stg_transaction", "id")})
        union all
        select 'part', id, amount, description, scraped_on from ({oracle.latest("stg_subtransaction", "id")})"""
)
def stream_budget_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that arrive over three runs; with the last ones come old ones again, with wrong amounts."""
    text = _order_texts(spark, sf)
    g = F.regexp_extract("value", '"server_knowledge":([0-9]+)', 1).cast("bigint")
    first = F.col("date") == adapters.V1.date().isoformat()
    run = F.when(~first, 3).otherwise(1 + F.floor(g / 2) % 2)
    marked = lambda mark: F.regexp_replace("value", F.lit('"server_knowledge":[0-9]+'), F.concat(F.lit('"server_knowledge":'), mark.cast("string")))
    root = scratch_dir(spark, "stream")
    once = F.struct(run.cast("int").alias("run"), marked(run).alias("value"))
    again = F.struct(F.lit(3).alias("run"), F.regexp_replace(marked(F.lit(1)), '"amount":', '"amount":7').alias("value"))
    sent = F.when(first & (run == 1), F.array(once, again)).otherwise(F.array(once))
    _write_documents(text.select("date", F.explode(sent).alias("sent")).select("date", "sent.*"), f"{root}/sent", "run")
    kinds = {"transaction": ("transactions", staging.stg_transaction), "part": ("subtransactions", staging.stg_subtransaction)}
    empty = budget.read_budget(spark, _nothing(spark, root), *(array for array, _ in kinds.values()), lines=True)
    tables = {
        kind: snapshots.Merged(
            stage, versioned.PartTable(spark, f"{root}/{kind}", stage(empty).schema, versioned.by_bucket(["id"], 8), few=True), ("id",)
        )
        for kind, (_, stage) in kinds.items()
    }
    for n in (1, 2, 3):
        for day in (adapters.V1, adapters.V2):  # the files of the run arrive
            folder = f"date={day.date().isoformat()}"
            move_files(spark, f"{root}/sent/run={n}/{folder}", f"{root}/in/by={lake.BUDGET_SOURCE}/{folder}", f"{n}-")
        for _ in range(2):  # the second run finds nothing new
            arriving = snapshots.budget_stream(spark, f"{root}/in", *(array for array, _ in kinds.values()))
            snapshots.merge_documents(arriving, list(tables.values()), snapshots.cursor_table(spark, f"{root}/cursor"), f"{root}/state")
    shown = [m.table.read().select(F.lit(kind).alias("kind"), "id", "amount", "description", "scraped_on") for kind, m in tables.items()]
    return shown[0].unionAll(shown[1])


def _nothing(spark: SparkSession, root: str) -> str:
    """A lake with a day without documents."""
    spark.createDataFrame([("", "2000-01-01")], "value string, date string").write.partitionBy("date").text(
        f"{root}/nothing/by={lake.BUDGET_SOURCE}"
    )
    return f"{root}/nothing"


@query(
    """select * replace ('b' || (cast(substr(id, 2) as bigint) // 32) % 2 as budget_id) from stg_transaction"""
)
def documents_to_transactions(spark: SparkSession, sf: str) -> DataFrame:
    root = _order_documents(spark, sf)
    return staging.stg_transaction(budget.read_budget(spark, root, "transactions", lines=True))


@query("select * from stg_subtransaction")
def documents_to_parts(spark: SparkSession, sf: str) -> DataFrame:
    root = _order_documents(spark, sf)
    return staging.stg_subtransaction(budget.read_budget(spark, root, "subtransactions", lines=True))


@query("select * from stg_budget_category")
def documents_to_months(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of a year, with months, with categories; one per file, over several lines."""
    rows = adapters.stg_budget_category(spark, sf).select("budget_month", "scraped_on", _category_entry().alias("entry"))
    months = rows.groupBy("budget_month", "scraped_on").agg(F.collect_list("entry").alias("categories"))
    month = F.struct(F.col("budget_month").cast("string").alias("month"), "categories")
    years = months.groupBy(F.year("budget_month").alias("year"), "scraped_on").agg(F.collect_list(month).alias("months"))
    fields = [F.lit("b0").alias("id"), F.col("months")]
    document = F.struct(F.struct(F.struct(*fields).alias("budget"), F.lit(1).cast("bigint").alias("server_knowledge")).alias("data"))
    text = years.select(F.to_json(document, {"pretty": "true"}).alias("value"), F.col("scraped_on").cast("date").alias("date"))
    root = scratch_dir(spark, "budget")
    text.write.partitionBy("date").option("maxRecordsPerFile", 1).text(f"{root}/by={lake.BUDGET_SOURCE}")
    return staging.stg_budget_category(budget.read_budget(spark, root, "months"))


@query("select * from stg_card")
def stg_card(spark: SparkSession, sf: str) -> DataFrame:
    """Cards out of the transit rows that carry them."""
    n = F.col("user_id") % 20
    versions = F.when(n % 4 == 0, F.array(F.lit(""), F.lit(" (old)"))).otherwise(F.array(F.lit(" (old)")))
    legs = adapters.load(spark, sf, "events").select(n.alias("n"), F.explode(versions).alias("suffix"))
    first, second = str(adapters.V1), str(adapters.V2)
    return staging.stg_card(
        legs.select(
            F.concat(F.lit("k"), F.col("n").cast("string")).alias("card_id"),
            F.concat(F.lit("Card "), F.col("n").cast("string"), "suffix").alias("card_name"),
            F.when(F.col("suffix") == "", second).otherwise(first).alias("scraped_on"),
        )
    )


@query("select payee_id, payee_name, is_unaccounted, is_passive from payee_flag")
def seed_flags(spark: SparkSession, sf: str) -> DataFrame:
    """A seed written as CSV with 0/1 flags and read with declared types."""
    root = scratch_dir(spark, "seed")
    flags = adapters.payee_flag(spark, sf)
    as_numbers = {c: F.col(c).cast("int") for c in ("is_unaccounted", "is_passive")}
    flags.withColumns(as_numbers).write.option("header", True).csv(root)
    return seeds.read_seed(spark, root, seeds.PAYEE_FLAG)


@query(
    """select 'k' || (user_id % 20) as card_id, 'Card ' || (user_id % 20) as card_name,
              'T' || user_id || '_L' || (event_id % 40) || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as trip_id,
              cast(case when leg = 1 and event_id % 4 = 0 then 0 else cast(value as decimal(18,2)) end
                   as decimal(18,7)) as cost_sgd,
              'Stop ' || (user_id + leg) as source, 'Stop ' || (event_id % 40 + leg) as destination,
              case when (event_id + leg) % 2 = 0 then 'Rail' else 'Bus' end as transport_mode,
              date_trunc('second', ts) + leg * interval 1 hour as traveled_on,
              cast(null as varchar) as posting_ref, timestamp '2024-02-01 10:00:00' as scraped_on
       from events, (values (0), (1)) as l(leg)"""
)
def journey_legs(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a card document with a two-leg journey and a record of another type."""
    key, user = F.col("event_id"), F.col("user_id")
    text_time = "yyyy-MM-dd'T'HH:mm:ss'Z'"

    def label(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), number.cast("string"))

    def leg(n: int):
        fare = F.concat(F.lit("$"), F.col("value").cast("decimal(18,2)").cast("string"))
        if n == 1:
            fare = F.when(key % 4 == 0, "Pass Usage").otherwise(fare)
        when = F.col("ts") + F.expr(f"interval {n} hour")
        return F.struct(
            F.when((key + n) % 2 == 0, "CTP Rail Usage Mtch")
            .otherwise("CTP Bus Usage Mtch")
            .alias("TransactionType"),
            F.date_format(when, text_time).alias("EntryTransactionDate"),
            fare.alias("Fare"),
            label("Stop ", user + n).alias("EntryLocationName"),
            label("Stop ", key % 40 + n).alias("ExitLocationName"),
        )

    def record(kind: str):
        return F.struct(
            F.lit(kind).alias("Type"),
            label("T", user).alias("TokenID"),
            label("L", key % 40).alias("EntryLocationId"),
            F.date_format("ts", text_time).alias("EntryTransactionDate"),
            F.array(leg(0), leg(1)).alias("Trips"),
        )

    card = F.struct(
        label("k", user % 20).alias("UniqueCode"),
        label("Card ", user % 20).alias("Description"),
        F.struct(F.array(record("Journey"), record("Top-up")).alias("Histories")).alias("transactions"),
    )
    text = adapters.load(spark, sf, "events").select(F.to_json(F.array(card)).alias("text"))
    cards = text.select(F.inline(journeys.card_documents(F.col("text"))))
    legs = journeys.journey_legs(cards, dt.datetime(2024, 2, 1, 10))
    names = F.concat(F.lit("Card "), F.substring("card_id", 2, 10)).alias("card_name")
    return staging.stg_trip_leg(legs).select("*", names)


def _export_name(key: Column, day: Column) -> Column:
    serial = F.lpad(key.cast("string"), 12, "0")
    return F.concat(F.lit("exports/ACC_TXN_History_"), F.date_format(day, "ddMMyyyy"), serial, F.lit(".xls"))


def _sheets(spark: SparkSession, sf: str) -> DataFrame:
    """A cell grid with one file per customer, its orders as table rows.

    Odd customers have the two amount columns swapped.
    """
    key = F.col("c_custkey")
    day = F.date_add(F.lit("1998-01-01").cast("date"), (key % 365).cast("int"))
    file_name = _export_name(key, day)
    swapped = key % 2 == 1
    empty = F.lit(None).cast("string")

    def row(n: int, *values):
        filled = [F.lit(v) if isinstance(v, str) else v for v in values]
        filled += [empty] * (5 - len(filled))
        return F.struct(
            F.lit(n).cast("bigint").alias("row_no"), *[v.alias(f"c{i}") for i, v in enumerate(filled)]
        )

    amounts = [F.when(swapped, a).otherwise(b) for a, b in (("Deposit", "Withdrawal"), ("Withdrawal", "Deposit"))]
    heads = F.array(
        row(0, "Statement"),
        row(1),
        row(2, "Company / Account:", F.col("c_name")),
        row(3, "Account Number:", F.concat(F.lit("v"), key.cast("string")), "SGD"),
        row(4, "Account Type:", F.col("c_mktsegment")),
        row(5, "Statement Period:", F.lit("01 Jan 1995 To 31 Dec 2001")),
        row(6, "Transaction Date", "Transaction Description", *amounts, "Available Balance"),
    )
    customers = adapters.load(spark, sf, "customer")
    # every customer becomes several rows: a task that reads them all would hold the whole of these
    top = customers.repartition("c_custkey").select(file_name.alias("file"), F.inline(heads))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    deposit = F.when(F.col("o_orderkey") % 3 == 0, price).otherwise("0")
    withdrawal = F.when(F.col("o_orderkey") % 3 == 0, "0").otherwise(price)
    body = (
        adapters.load(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == key)
        .select(
            file_name.alias("file"),
            (F.col("o_orderkey") + 7).alias("row_no"),
            F.date_format("o_orderdate", "dd MMM yyyy").alias("c0"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("c1"),
            F.when(swapped, deposit).otherwise(withdrawal).alias("c2"),
            F.when(swapped, withdrawal).otherwise(deposit).alias("c3"),
            price.alias("c4"),
        )
    )
    return top.unionByName(body)


@query(
    """select cast(o_orderdate as date) as transacted_on, 'Order ' || o_orderkey as description,
              'v' || c_custkey as account_no, c_mktsegment as name,
              cast(case when o_orderkey % 3 = 0 then cast(o_totalprice as decimal(18,2)) else 0 end
                   as decimal(18,7)) as deposit,
              cast(case when o_orderkey % 3 = 0 then 0 else cast(o_totalprice as decimal(18,2)) end
                   as decimal(18,7)) as withdrawal,
              cast(cast(o_totalprice as decimal(18,2)) as decimal(18,7)) as balance, 'SGD' as currency_code,
              timestamp '1995-01-01 00:00:00' as statement_begin, timestamp '2001-12-31 00:00:00' as statement_end,
              cast(date '1998-01-01' + cast(c_custkey % 365 as integer) as timestamp) as scraped_on
       from orders join customer on o_custkey = c_custkey"""
)
def report_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sectioned sheets to typed statement rows."""
    return staging.stg_statement(statements.stage_statements(_sheets(spark, sf)))


BANK_SQL = SQL["report_sections"]


@query(BANK_SQL)
def bank_lake_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets to rows, staged in the lake by day of the export, read back and typed."""
    root = scratch_dir(spark, "bank")
    rows = statements.stage_statements(_sheets(spark, sf))
    lake.stage_snapshots(rows, root, lake.BANK_SOURCE)
    return staging.stg_statement(lake.read_parquet_snapshots(spark, root, lake.BANK_SOURCE))


@query(
    """select event_id, user_id, value + 2 as value, timestamp '2024-02-01 18:00:00' as scraped_at from events
       where event_id % 3 = 0
       union all select event_id, user_id, value + 1, timestamp '2024-02-01 09:00:00' from events where event_id % 3 = 1
       union all select event_id, user_id, value, timestamp '2024-01-31 09:00:00' from events where event_id % 3 = 2"""
)
def landed_snapshots_newest(spark: SparkSession, sf: str) -> DataFrame:
    """Three scrapes, two of them on one day, landed one after the other; the newest version of each counts."""
    root = scratch_dir(spark, "landed")
    events = adapters.load(spark, sf, "events").select("event_id", "user_id", "value")
    scrapes = [("2024-02-01 18:00:00", 2, "event_id % 3 = 0"), ("2024-01-31 09:00:00", 0, "true"), ("2024-02-01 09:00:00", 1, "event_id % 3 < 2")]
    for at, add, which in scrapes:
        scrape = events.filter(which).withColumn("value", F.col("value") + add)
        lake.land_snapshots(scrape.withColumn("scraped_at", F.lit(at).cast("timestamp_ntz")), root, "events")
    landed = lake.read_parquet_snapshots(spark, root, "events")
    return dedupe.latest_per_key(landed, ["event_id"], "scraped_at").select("event_id", "user_id", "value", "scraped_at")


@query(
    """with days as (select c_custkey, date '1998-01-01' + cast(c_custkey % 28 as integer) * 13 as day from customer)
       select c_custkey, cast(day as date) as date from days where day = (select max(day) from days)"""
)
def newest_export_file(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the newest export out of the files of a folder, found by their paths."""
    root = scratch_dir(spark, "exports")
    key = F.col("c_custkey")
    day = F.date_add(F.lit("1998-01-01").cast("date"), (key % 28 * 13).cast("int"))
    named = F.concat(F.lit("ACC_TXN_History_"), F.date_format(day, "ddMMyyyy"), F.lit(".xls"))
    adapters.load(spark, sf, "customer").select("c_custkey", named.alias("export")).write.partitionBy("export").parquet(root)
    folder = F.regexp_extract("_metadata.file_path", "[^/=]+[.]xls", 0).alias("file")
    files = spark.read.parquet(root).select(folder, "c_custkey")
    return statements.newest_export(files).select("c_custkey", "date")


@query(
    """select 'account' as seed, budget_account_id as id, vendor, vendor_id from account_map
       union all select 'card', bank_card_id, vendor, vendor_id from card_map"""
)
def seed_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Both map seeds, written as CSV and read with declared types."""
    out = []
    for name, rows, schema in (
        ("account", adapters.account_map(spark, sf), seeds.ACCOUNT_MAP),
        ("card", adapters.card_map(spark, sf), seeds.CARD_MAP),
    ):
        root = scratch_dir(spark, "seed")
        rows.write.option("header", True).csv(root)
        seed = seeds.read_seed(spark, root, schema)
        out.append(seed.select(F.lit(name).alias("seed"), F.col(seed.columns[0]).alias("id"), "vendor", "vendor_id"))
    return out[0].union(out[1])


@query(
    """select 'exports/ACC_TXN_History_' || strftime(day, '%d%m%Y') || lpad(cast(c_custkey as varchar), 12, '0')
              || '.xls' as file, day as date, c_custkey
       from (select c_custkey, cast(date '1998-01-01' + cast(c_custkey % 365 as integer) as date) as day
             from customer)
       order by date desc, file desc limit 1"""
)
def newest_export(spark: SparkSession, sf: str) -> DataFrame:
    """The newest of all export files by the day in its name."""
    key = F.col("c_custkey")
    day = F.date_add(F.lit("1998-01-01").cast("date"), (key % 365).cast("int"))
    files = adapters.load(spark, sf, "customer").select(_export_name(key, day).alias("file"), "c_custkey")
    return statements.newest_export(files)


@query(oracle.latest("stg_trip_leg", "trip_id"))
def lake_roundtrip_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Transit snapshots written as a partitioned lake, read back, staged and made unique."""
    legs = adapters.stg_trip_leg(spark, sf).select(
        "trip_id",
        F.coalesce("posting_ref", F.lit("")).alias("posting_ref"),
        F.col("traveled_on").cast("string").alias("traveled_on"),
        F.col("cost_sgd").cast("string").alias("cost_sgd"),
        "source",
        "destination",
        F.col("transport_mode").alias("mode"),
        "card_id",
        F.col("scraped_on").cast("string").alias("scraped_on"),
        F.to_date("scraped_on").alias("date"),
    )
    root = scratch_dir(spark, "transit")
    lake.stage_snapshots(legs, root, lake.TRANSIT_SOURCE)
    staged = staging.stg_trip_leg(lake.read_parquet_snapshots(spark, root, lake.TRANSIT_SOURCE))
    return dedupe.latest_per_key(staged, ["trip_id"])


@query(
    """select event_id, ts, user_id, value from events
       where event_id > (select max(event_id) from events where ts < timestamp '2024-01-20 00:00:00')"""
)
def incremental_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """Events beyond the mark of those landed before a day."""
    events = adapters.load(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    landed = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return incremental.newer_than(events, "event_id", landed)


@query(
    oracle.latest(
        "stg_trip_leg where traveled_on >= timestamp '2024-01-10' and traveled_on < timestamp '2024-01-14'",
        "trip_id",
    )
)
def late_window(spark: SparkSession, sf: str) -> DataFrame:
    """A day and the three after it, re-read in full; the newest scrape wins."""
    legs = incremental.late_window(adapters.stg_trip_leg(spark, sf), "traveled_on", dt.date(2024, 1, 10), 3)
    return dedupe.latest_per_key(legs, ["trip_id"])


# --- checks -----------------------------------------------------------------


def _built(spark: SparkSession, sf: str) -> Warehouse:
    """A warehouse whose models are stored, as checks run on built tables."""
    return adapters.warehouse(spark, sf, store=lake.TableStore(spark, scratch_dir(spark, "warehouse")))


def _checked(spark: SparkSession, sf: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Built models, and staged inputs as they are stored: checks pass over their rows only."""
    w, staged = _built(spark, sf), adapters.staging(spark, sf, passed=True)
    return {name: getattr(staged, name) if name in Staging.NAMES else w.table(name) for name in names}


def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Every row check of every table, one pass per table."""
    rules = {name: wanted for name, wanted in checks.ALL.items() if quality.row_rules(wanted)}
    tables = _checked(spark, sf, rules)
    counted = [quality.check_rows(name, tables[name], wanted) for name, wanted in rules.items()]
    return reduce(DataFrame.unionAll, counted)


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Every unique column of every table, one pass per table and one shuffle."""
    rules = quality.unique_rules(checks.ALL)
    return quality.check_unique(_checked(spark, sf, dict.fromkeys(name for name, _ in rules)), rules)


def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Every foreign key of every table, one pass per child and one join."""
    rules = quality.reference_rules(checks.ALL)
    names = dict.fromkeys(name for child, _, parent, _ in rules for name in (child, parent))
    return quality.check_relationships(_checked(spark, sf, names), rules)


for _run, _sql in (
    (dq_summary, oracle.check_rows_sql),
    (dq_unique, oracle.check_unique_sql),
    (dq_relationships, oracle.check_relationships_sql),
):
    QUERIES[_run.__name__] = _run
    SQL[_run.__name__] = _sql(checks.ALL)


@query(
    f"""select e.account_id, e.balance as expected, a.balance as actual
        from ({oracle.first('int_enriched_bank_statement', 'account_id', 'scraped_on desc, transacted_on desc, id')}) e
        left join (select account_id, cast(sum(amount) as {oracle.SUM}) as balance
                   from fact_vendor_transaction group by 1) a on e.account_id = a.account_id
        where e.balance <> a.balance"""
)
def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.with_lookups(spark, sf).check_balances()


# --- streaming --------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The table of events as a stream of its files: one, or those of a folder.

    A pattern may stand for either; a plain path would have to be a folder.
    """
    return snapshots.file_stream(spark, f"{sf}/[e]vents.parquet", adapters.load(spark, sf, "events").schema, "*.parquet")


@query(oracle.latest("stg_trip_leg", "trip_id"))
def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """New snapshot files picked up by a stream and landed; readers take the newest version."""
    legs = adapters.trip_legs(_event_stream(spark, sf))
    root = scratch_dir(spark, "stream")
    snapshots.land(legs, f"{root}/out", f"{root}/state")
    landed = spark.read.schema(legs.schema).parquet(f"{root}/out")
    return dedupe.latest_per_key(landed, ["trip_id"])


@query("select event_id, ts, user_id, value from events")
def stream_exact_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """A stream in which every event is delivered twice, within the window for late data."""
    raw = _event_stream(spark, sf)
    twice = raw.select("event_id", "ts", "user_id", "value", F.explode(F.array(F.lit(1), F.lit(2)))).drop("col")
    root = scratch_dir(spark, "stream")
    snapshots.land(snapshots.without_repeats(twice, "ts", ["event_id"]), f"{root}/out", f"{root}/state")
    return spark.read.schema(twice.schema).parquet(f"{root}/out").select("event_id", "ts", "user_id", "value")


@query(oracle.latest("stg_trip_leg", "trip_id"))
def stream_newest_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Scrapes that arrive in several batches; each batch rewrites the days that it touches."""
    root = scratch_dir(spark, "stream")
    legs = adapters.stg_trip_leg(spark, sf).withColumn("day", F.to_date("traveled_on"))
    # each file is a batch; which versions of a leg come first is left to chance
    legs.repartition(4, F.xxhash64("trip_id", "scraped_on")).write.parquet(f"{root}/in")
    arriving = snapshots.file_stream(spark, f"{root}/in", legs.schema, max_files=1)
    snapshots.land_newest(arriving, f"{root}/out", f"{root}/state", ["trip_id"], "day", "scraped_on")
    return spark.read.schema(legs.schema).parquet(f"{root}/out").drop("day")


_ARRIVALS = """
    arrivals as (
        select event_id, ts, user_id, value,
               (day(ts) - 1) // 6 + case event_id % 20 when 0 then 1 when 1 then 2 else 0 end as batch from events),
    seen as (select batch, max(ts) as newest from arrivals group by 1),
    bounds as (select b.batch, max(e.newest) - interval 3 day as bound from seen b join seen e on e.batch < b.batch group by 1)"""


@query(
    f"""with {_ARRIVALS},
             told as (select a.*, coalesce(ts < bound, false) as is_late from arrivals a left join bounds using (batch))
        select event_id, ts, user_id, value, is_late, cast(if(is_late, batch, null) as integer) as batch
        from told, range(2) copy where range = 0 or (is_late and event_id % 3 = 0)"""
)
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events in arrivals of six days each; some come one or two arrivals later, a third of them twice."""
    root = scratch_dir(spark, "stream")
    key, delay = F.col("event_id"), F.col("event_id") % 20
    events = adapters.load(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    arrival = F.floor((F.dayofmonth("ts") - 1) / 6) + F.when(delay == 0, 1).when(delay == 1, 2).otherwise(0)
    again = F.explode(F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    events.withColumn("arrival", arrival).select("*", again.alias("copy")).drop("copy").write.partitionBy("arrival").parquet(f"{root}/sent")
    for n in range(7):
        sent = spark.read.parquet(f"{root}/sent").filter(F.col("arrival") == n).drop("arrival")
        sent.write.mode("append").parquet(f"{root}/in")
        arriving = snapshots.file_stream(spark, f"{root}/in", events.schema)
        snapshots.land_with_late(arriving, f"{root}/out", f"{root}/state", ["event_id"], "ts")
    landed = snapshots.landed(spark, f"{root}/out", events.schema)
    late = snapshots.late(spark, f"{root}/out", events.schema).withColumn("is_late", F.lit(True))
    return landed.withColumn("is_late", F.lit(False)).unionByName(late, allowMissingColumns=True)


@query(oracle.latest("stg_trip_leg", "trip_id"))
def stream_atomic_days(spark: SparkSession, sf: str) -> DataFrame:
    """Scrapes that arrive in several batches, each published as a whole over the days that it touches."""
    root = scratch_dir(spark, "stream")
    legs = adapters.stg_trip_leg(spark, sf)
    legs.repartition(4, F.xxhash64("trip_id", "scraped_on")).write.parquet(f"{root}/in")
    arriving = snapshots.file_stream(spark, f"{root}/in", legs.schema, max_files=1)
    table = versioned.PartTable(spark, f"{root}/out", legs.schema, versioned.by_day("traveled_on"))
    snapshots.merge_newest(arriving, table, f"{root}/state", ["trip_id"], "scraped_on")
    return table.read()


@query(oracle.latest("stg_transaction", "id"))
def incremental_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest version of every transaction, kept over three loads that read no more than they touch."""
    scrapes = adapters.stg_transaction(spark, sf)
    table = versioned.PartTable(spark, scratch_dir(spark, "newest"), scrapes.schema, versioned.by_bucket(["id"], 16))
    load = F.pmod(F.xxhash64("id", "scraped_on"), F.lit(3))
    for n in range(3):
        table.merge(scrapes.filter(load == n), ["id"], "scraped_on")
    return table.read()


@query(
    """select 'dev' as target, least(count(*), 100) as n_rows from events
       union all select 'prod', count(*) from events"""
)
def dev_limit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a model of a development run and of a production run reads."""
    events = adapters.load(spark, sf, "events")
    counted = [dedupe.dev_limit(events, t).agg(F.lit(t).alias("target"), F.count("*").alias("n_rows")) for t in ("dev", "prod")]
    return counted[0].union(counted[1])
