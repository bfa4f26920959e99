"""Operators on small frames, against brute force where semantics are easy to get wrong."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from tallyhouse.operators import calendar, dedupe, joins, quality, ranks, reports, scd, series, unnest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- first row per key


def test_newest_wins_with_nulls_last_and_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "n"), ("b", 0, "m"), (None, 5, "k")],
        "id string, v int, name string",
    )
    assert rows(dedupe.latest_per_key(df, ["id"], "v", ["name"])) == [("a", 2, "y"), ("b", 0, "m"), (None, 5, "k")]
    assert rows(dedupe.earliest_per_key(df, ["id"], "v", ["name"])) == [("a", 1, "x"), ("b", 0, "m"), (None, 5, "k")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    key = F.when(F.col("id") < 10_000, "hot").otherwise("cold")
    df = spark.range(0, 10_000, 1, 4).select(key.alias("k"), "id", F.lit(1).alias("v"))
    newest = dedupe.latest_per_key(df, ["k"], "v", ["id"])
    text = plan(newest)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert [tuple(r) for r in newest.collect()] == [("hot", 0, 1)]


def test_deleted_newest_version_hides_older_ones(spark, rows):
    from tallyhouse.plans.facts import int_unique_transaction

    df = spark.createDataFrame(
        [("t1", 1, False), ("t1", 2, True), ("t2", 1, True), ("t2", 2, False)],
        "id string, scraped_on int, is_deleted boolean",
    ).withColumns({"amount": F.lit(1), "description": F.lit("")})
    assert rows(int_unique_transaction(df), "id") == [("t2",)]


def test_dev_limit(spark):
    df = spark.range(500)
    assert dedupe.dev_limit(df).count() == 500
    assert dedupe.dev_limit(df, "dev").count() == 100
    assert dedupe.dev_limit(df, "dev", 7).count() == 7


# --- joins


def either_key_cases():
    rng = random.Random(7)
    for _ in range(4):
        ids = [f"t{i}" for i in range(8)]
        parents = [(i, rng.choice([None, "m1", "m2", i, rng.choice(ids)]), rng.randint(0, 9)) for i in ids]
        children = [
            (f"s{n}", rng.choice([*ids, "m1", "m2", "other", None]), n) for n in range(rng.choice([0, 6, 20]))
        ]
        yield parents, children


@pytest.mark.parametrize("parents, children", list(either_key_cases()))
def test_either_key_left_join_matches_brute_force(spark, rows, parents, children):
    p = spark.createDataFrame(parents, "id string, alt string, x int")
    c = spark.createDataFrame(children, "id string, ref string, y int")
    got = joins.either_key_left_join(p, c, "id", "alt", "ref")
    want = []
    for parent in parents:
        matched = [s for s in children if s[1] is not None and s[1] in (parent[0], parent[1])]
        want += [(*parent, *s) for s in matched] or [(*parent, None, None, None)]
    assert rows(got, "id", "alt", "x", "child_id", "child_ref", "child_y") == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_full_join_matches_built_in(spark, rows):
    rng = random.Random(3)

    def side(name):
        data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), f"{name}{i}") for i in range(12)]
        return spark.createDataFrame(data, f"k string, n int, {name} string")

    left, right = side("l"), side("r")
    got = joins.full_join(left, right, ["k", "n"])
    assert rows(got, "k", "n", "l", "r") == rows(left.join(right, ["k", "n"], "full"), "k", "n", "l", "r")


@pytest.fixture
def hot_sides(spark):
    """A third of each side's rows on one key, and another third without one."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, -F.col("id")).cast("int").alias("k")
    left = spark.range(0, 1200, 1, 8).select(key, F.lit("x").alias("a"), F.col("id").alias("l"))
    right = spark.range(0, 900, 1, 8).select(key, F.lit("x").alias("a"), (F.col("id") * 10).alias("r"))
    return left, right


def test_full_join_cuts_a_hot_key_into_small_groups(spark, rows, hot_sides):
    left, right = hot_sides
    want = rows(left.join(right, ["k", "a"], "full"), "k", "a", "l", "r")
    for size in (7, 50, 1024):
        got = joins.full_join(left, right, ["k", "a"], slice_rows=size)
        assert rows(got, "k", "a", "l", "r") == want
    # pairs of the hot key: 400 by 300 rows; in 8 by 6 groups they are dealt over all tasks
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        listed = joins.full_join(left, right, ["k", "a"], slice_rows=50)
        shares = listed.filter("k = 7").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set(name, before)
    assert sum(r["count"] for r in shares) == 400 * 300
    assert len(shares) > 1 and max(r["count"] for r in shares) < 0.6 * 400 * 300


def test_full_join_takes_three_exchanges(spark, hot_sides):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        text = plan(joins.full_join(*hot_sides, ["k", "a"]))
    finally:
        spark.conf.set(name, before)
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("SortMergeJoin") == 1 and "FullOuter" not in text


def test_full_join_of_empty_sides_and_sides_without_columns(spark, rows):
    keys = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    none = spark.createDataFrame([], "k int, v int")
    assert rows(joins.full_join(keys, none, ["k"]), "k", "v") == [(1, None), (2, None), (None, None)]
    assert rows(joins.full_join(none, keys, ["k"]), "k", "v") == [(1, None), (2, None), (None, None)]
    assert rows(joins.full_join(none, none.withColumnRenamed("v", "w"), ["k"])) == []


def test_ranks_of_a_hot_key_are_counted_in_ranges(spark, rows):
    df = spark.range(0, 5000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, F.concat(F.lit("k"), F.col("id") % 10)).alias("k"),
        F.when(F.col("id") % 50 > 0, F.col("id") * 7919 % 5000).alias("day"), F.col("id").alias("n"),
    )
    order = [F.col("day").asc_nulls_last(), F.col("n").asc_nulls_last()]
    got = ranks.rank_in_key(df, ["k"], order, "place")
    plain = df.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert rows(got, "k", "n", "place") == rows(plain, "k", "n", "place")
    assert rows(ranks.rank_in_key(df.filter("n < 0"), ["k"], order)) == []


def test_semi_and_anti_join_null_keys(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert rows(joins.semi_join(df, keys, "k", "key")) == [("a",)]
    assert rows(joins.anti_join(df, keys, "k", "key")) == [("b",), (None,)]


def test_hot_keys_are_split_by_adaptive_execution(spark):
    """A key with most of the rows must not end up in one task of the match."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        parents = spark.range(0, 2000, 1, 4).select(
            F.concat(F.lit("t"), "id").alias("id"), F.lit(None).cast("string").alias("alt")
        )
        hot = F.when(F.col("id") % 3 == 0, "t5").otherwise(F.concat(F.lit("t"), F.col("id") % 2000))
        children = spark.range(0, 60_000, 1, 8).select(
            F.md5(F.col("id").cast("string")).alias("id"), hot.alias("ref")
        )
        out = joins.either_key_left_join(parents, children, "id", "alt", "ref")
        # a window-free consumer, so that the final plan of this very execution can be read
        rows = out.collect()
        assert len(rows) == 60_000 + 0
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# --- history


def test_validity(spark, rows):
    df = spark.createDataFrame(
        [("c1", dt.date(2024, 1, 1)), ("c1", dt.date(2024, 3, 1)), ("c2", dt.date(2024, 2, 1))],
        "category string, month date",
    )
    out = scd.with_validity(df, "category", "month").withColumn("until", F.col("expired_at").cast("date"))
    assert rows(out, "category", "month", "until", "is_current") == [
        ("c1", dt.date(2024, 1, 1), dt.date(2024, 3, 1), False),
        ("c1", dt.date(2024, 3, 1), dt.date(9999, 12, 31), True),
        ("c2", dt.date(2024, 2, 1), dt.date(9999, 12, 31), True),
    ]


# --- series


@pytest.fixture
def monthly(spark):
    data = [(1, "10"), (2, "-30"), (3, "0"), (5, "5")]
    return spark.createDataFrame(
        [(dt.date(2024, m, 1), Decimal(v)) for m, v in data], "period date, value decimal(18,7)"
    )


def test_running_total_rolling_mean_and_change(monthly):
    got = monthly.select(
        series.running_total("value", "period").alias("total"),
        series.rolling_mean("value", "period", 2).alias("mean"),
        series.change_from_previous("value", "period").alias("change"),
    ).collect()
    assert [float(r["total"]) for r in got] == [10, -20, -20, -15]
    assert [r["mean"] for r in got] == [10, -10, -15, 2.5]
    assert [r["change"] for r in got] == [None, -4, 1, None]


def test_latest_period_and_top_k(monthly):
    assert tuple(series.latest_period(monthly, "period").first()) == (dt.date(2024, 5, 1), Decimal(5))
    assert [r["period"].month for r in series.top_k(monthly, "value", 2, ["period"]).collect()] == [1, 5]


# --- calendar


def test_calendar_end_is_exclusive(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 2, 27), dt.date(2024, 3, 2))], "a date, b date")
    days = calendar.day_spine(bounds, F.col("a"), F.col("b"))
    assert [r[0].isoformat() for r in days.collect()] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert calendar.day_spine(bounds, F.col("b"), F.col("a")).count() == 0


# --- documents and sheets


def test_unnest_keeps_parent_fields_and_drops_empty(spark, rows):
    df = spark.createDataFrame(
        [("b1", [(1, "x"), (2, "y")]), ("b2", []), ("b3", None)], "id string, items array<struct<n: int, t: string>>"
    )
    assert rows(unnest.unnest(df, "items", {"budget_id": F.col("id")})) == [("b1", 1, "x"), ("b1", 2, "y")]


GRID = [
    (0, "title", None, None, None, None),
    (1, None, None, None, None, None),
    (2, "Company:", "dropped", None, None, None),
    (3, "Account Number:", "77-0042", "SGD", None, None),
    (4, "Account Type:", "Household", None, None, None),
    (5, "Statement Period:", "01 Jan 2022 To 31 Mar 2022", None, None, None),
    (6, "Transaction Date", "Transaction Description", "Withdrawal", "Deposit", "Available Balance"),
    (7, "30 Mar 2022", "Refund and rebooking", "12.5", "80.25", "913.4"),
    (8, "11 Jan 2022", "Bakery", "3.75", None, "845.65"),
]
GRID_SCHEMA = "file string, row_no bigint, c0 string, c1 string, c2 string, c3 string, c4 string"


def grid(spark, cells, file="ACC_TXN_History_01042022.xls"):
    return spark.createDataFrame([(file, *row) for row in cells], GRID_SCHEMA)


def test_sheets_to_rows(spark, rows):
    swapped = [(n, a, b, d, c, e) if n >= 6 else (n, a, b, c, d, e) for n, a, b, c, d, e in GRID]
    both = grid(spark, GRID).unionByName(grid(spark, swapped, "ACC_TXN_History_02042022.xls"))
    out = reports.extract_sheets(both)
    meta = ("77-0042", "Household", "01 Jan 2022 To 31 Mar 2022", "SGD")
    want = [
        ("30 Mar 2022", "Refund and rebooking", 12.5, 80.25, 913.4, *meta),
        ("11 Jan 2022", "Bakery", 3.75, None, 845.65, *meta),
    ]
    assert out.columns == [
        "file", "Transaction Date", "Transaction Description", "Withdrawal", "Deposit", "Available Balance",
        "Account Number", "Account Type", "Statement Period", "Currency",
    ]
    assert rows(out.drop("file")) == sorted(want * 2, key=repr)


def test_sheet_without_a_column_fails(spark):
    cells = [(n, a, b, c, "Credit" if n == 6 else d, e) for n, a, b, c, d, e in GRID]
    with pytest.raises(PySparkException, match="missing table column"):
        reports.extract_sheets(grid(spark, cells)).collect()


# --- checks


def test_checks_count_failures_and_let_nulls_pass(spark, rows):
    table = spark.createDataFrame(
        [("a", 1, "x", "p1"), ("a", -1, "y", "p9"), (None, None, None, None), ("b", 5, "x", "p9")],
        "id string, n int, kind string, parent string",
    )
    parents = spark.createDataFrame([("p1",), (None,)], "id string")
    wanted = {
        "t": quality.Checks(
            "id n",
            unique="id",
            refers={"parent": ("parents", "id")},
            values={"kind": ("x",)},
            ranges={"n": quality.Range(0, 5, inclusive=False)},
            holds={"short": "length(id) = 1"},
        )
    }
    out = quality.run_checks({"t": table, "parents": parents}, wanted)
    assert rows(out, "check_name", "column_name", "n_failed") == [
        ("accepted_range", "n", 2),
        ("accepted_values", "kind", 1),
        ("expression_is_true", "short", 0),
        ("not_null", "id", 1),
        ("not_null", "n", 1),
        ("relationships", "parent", 2),
        ("unique", "id", 1),
    ]


def test_key_checks_read_each_table_once(spark, rows):
    child = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "z", "y"), (3, "z", None)], "id int, p string, q string")
    parent = spark.createDataFrame([("a", 1), ("b", 1), ("b", None)], "id string, n int")
    tables = {"c": child, "p": parent}
    unique = quality.check_unique(tables, [("c", "id"), ("c", "p"), ("p", "id"), ("p", "n")])
    assert rows(unique, "table_name", "column_name", "n_failed") == [("c", "id", 1), ("c", "p", 1), ("p", "id", 1), ("p", "n", 1)]
    refers = [("c", "p", "p", "id"), ("c", "q", "p", "id"), ("c", "id", "p", "n"), ("p", "n", "c", "id")]
    dangling = quality.check_relationships(tables, refers)
    assert rows(dangling, "table_name", "column_name", "n_failed") == [("c", "id", 2), ("c", "p", 2), ("c", "q", 3), ("p", "n", 0)]
    assert plan(unique).count("Scan ExistingRDD") == 2
    assert plan(dangling).count("Scan ExistingRDD") == 4  # each as a child, and as a parent


def test_key_checks_of_empty_tables(spark, rows):
    none = spark.createDataFrame([], "id int")
    assert rows(quality.check_unique({"t": none}, [("t", "id")]), "n_failed") == [(0,)]
    assert rows(quality.check_relationships({"t": none}, [("t", "id", "t", "id")]), "n_failed") == [(0,)]


def test_row_checks_read_the_table_once(spark):
    df = spark.range(10).withColumn("n", F.col("id"))
    out = quality.check_rows("t", df, quality.Checks("id n", ranges={"n": quality.Range(0)}))
    assert plan(out).count("Range (0, 10") == 1


def test_sheet_heads_are_dealt_out_before_they_are_sorted(spark):
    from tallyhouse.operators.reports import SheetLayout, sheet_heads

    names = [f"c{i}" for i in range(5)]
    grid = spark.range(0, 700, 1, 1).select(
        F.concat(F.lit("f"), F.floor(F.col("id") / 7)).alias("file"), (F.col("id") % 7).alias("row_no"), *(F.lit(n).alias(n) for n in names)
    )
    heads = sheet_heads(grid, SheetLayout())
    plan = heads._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.index("Exchange"):]
    assert heads.count() == 100 and heads.filter("Currency = 'c2' and head_c1 = 'c1'").count() == 100
