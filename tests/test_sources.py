"""Reading and writing of lakes, documents, seeds and exports."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.plans import staging
from tallyhouse.sources import budget, incremental, journeys, lake, seeds, statements

BUDGET = {
    "id": "b1",
    "name": "Home",
    "last_modified_on": "2024-01-05T10:00:00+00:00",
    "currency_format": {"iso_code": "SGD", "currency_symbol": "$", "decimal_digits": 2},
    "accounts": [
        {"id": "a1", "name": "Cash", "type": "cash", "on_budget": True, "closed": False, "deleted": False,
         "transfer_payee_id": "p1", "last_reconciled_at": "2024-01-01T00:00:00Z", "note": "unread"}
    ],
    "payees": [{"id": "p1", "name": "Shop", "transfer_account_id": None, "deleted": False}],
    "category_groups": [{"id": "g1", "name": "Expenses: Home", "hidden": False, "deleted": False}],
    "months": [
        {"month": "2024-01-01", "categories": [
            {"id": "c1", "category_group_id": "g1", "name": "Food", "budgeted": 250500, "goal_type": "NEED",
             "goal_target": 300000, "goal_target_month": None, "deleted": False},
            {"id": "c2", "category_group_id": "g1", "name": "Rent", "budgeted": 0, "goal_type": None,
             "goal_target": 0, "goal_target_month": None, "deleted": False},
        ]},
        {"month": "2024-02-01", "categories": []},
    ],
    "transactions": [
        {"id": "t1", "date": "2024-01-03", "amount": -12345, "memo": "lunch", "cleared": "uncleared",
         "approved": True, "account_id": "a1", "payee_id": "p1", "category_id": "c1",
         "transfer_account_id": None, "matched_transaction_id": "m1", "deleted": False}
    ],
    "subtransactions": [
        {"id": "s1", "transaction_id": "m1", "amount": -345, "memo": None, "payee_id": None,
         "category_id": "c2", "transfer_account_id": None, "deleted": False}
    ],
}


@pytest.fixture
def budget_lake(tmp_path):
    later = {**BUDGET, "name": "Home 2", "transactions": []}
    del later["subtransactions"]
    for day, time, doc, mark in (
        ("2024-01-05", "20240105T100000Z", BUDGET, 10),
        ("2024-01-06", "20240106T100000Z", later, 11),
        ("2024-01-06", "20240106T200000Z", later, 12),
    ):
        folder = tmp_path / "by=ynab" / f"date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{time}.json").write_text(json.dumps({"data": {"budget": doc, "server_knowledge": mark}}, indent=1))
    return str(tmp_path)


def test_budget_documents_to_staging(spark, rows, budget_lake):
    def stage(model, *entities):
        return getattr(staging, model)(budget.read_budget(spark, budget_lake, *entities))

    first, second = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)
    assert rows(stage("stg_budget")) == [
        ("b1", "Home 2", dt.datetime(2024, 1, 5, 10), "SGD", "$", second),
        ("b1", "Home 2", dt.datetime(2024, 1, 5, 10), "SGD", "$", second),
        ("b1", "Home", dt.datetime(2024, 1, 5, 10), "SGD", "$", first),
    ]
    accounts = stage("stg_account", "accounts")
    assert accounts.count() == 3
    assert tuple(accounts.filter(F.col("scraped_on") == F.lit(first)).first()) == (
        "a1", "Cash", "cash", True, False, False, "p1", dt.datetime(2024, 1, 1), first
    )
    assert rows(stage("stg_payee", "payees").distinct(), "id", "name") == [("p1", "Shop")] * 2
    assert stage("stg_category_group", "category_groups").first()["name"] == "Expenses: Home"
    categories = stage("stg_budget_category", "months").filter(F.col("scraped_on") == F.lit(first))
    assert rows(categories, "id", "budget_id", "budget_amount", "budget_month", "goal_type", "goal_amount") == [
        ("c1", "b1", Decimal("250.5"), dt.date(2024, 1, 1), "Plan Your Spending", Decimal(300)),
        ("c2", "b1", Decimal(0), dt.date(2024, 1, 1), None, Decimal(0)),
    ]
    # arrays that are empty or missing in a document give no rows
    assert rows(stage("stg_transaction", "transactions"), "id", "amount", "description", "date", "scraped_on") == [
        ("t1", Decimal("-12.345"), "lunch", dt.date(2024, 1, 3), first)
    ]
    assert rows(stage("stg_subtransaction", "subtransactions"), "id", "super_id", "amount") == [
        ("s1", "m1", Decimal("-0.345"))
    ]


def test_incremental_mark(spark, rows, budget_lake):
    docs = budget.read_budget(spark, budget_lake).select(F.col("data.server_knowledge").alias("mark"), "date")
    landed = docs.filter("mark <= 10")
    assert incremental.high_water_mark(landed, "mark") == 10
    assert rows(incremental.newer_than(docs, "mark", landed), "mark") == [(11,), (12,)]
    # nothing landed yet: full load, whatever the marks
    assert incremental.newer_than(docs, "mark", landed.filter("false")).count() == 3
    marks = spark.createDataFrame([(0,), (-1,), (None,), (3,)], "mark int")
    assert incremental.newer_than(marks, "mark", marks.filter("mark > 9")).count() == 4
    # a snapshot without a mark is new each time
    assert rows(incremental.newer_than(marks, "mark", marks.filter("mark = 0"))) == [(3,), (None,)]


def test_stage_and_land(spark, rows, tmp_path):
    root = str(tmp_path)

    def day(d, *values):
        return spark.createDataFrame([(v, dt.date(2024, 1, d)) for v in values], "v int, date date")

    lake.stage_snapshots(day(1, 1, 2), root, "uob")
    lake.stage_snapshots(day(2, 3), root, "uob")
    lake.stage_snapshots(day(1, 9), root, "uob")
    lake.stage_snapshots(day(1), root, "uob")  # empty: changes nothing
    out = lake.read_parquet_snapshots(spark, root, "uob")
    assert rows(out, "v", "by", "date") == [(3, "uob", dt.date(2024, 1, 2)), (9, "uob", dt.date(2024, 1, 1))]
    # a filter on the day reads only its folder
    assert "PartitionFilters: [isnotnull(date" in out.filter("date = '2024-01-02'")._jdf.queryExecution().toString()

    for hour in (8, 20):
        snap = spark.createDataFrame([(hour, dt.datetime(2024, 1, 3, hour))], "v int, scraped_at timestamp_ntz")
        lake.land_snapshots(snap, root, "budget")
    landed = lake.read_parquet_snapshots(spark, root, "budget")
    assert rows(landed, "v", "date") == [(20, dt.date(2024, 1, 3)), (8, dt.date(2024, 1, 3))]


def test_parquet_files_with_short_suffix(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "by=simplygo_tfm" / "date=2024-01-01"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"trip_id": ["x"]}), folder / "out.pq")
    (folder / "notes.txt").write_text("not a table")
    out = lake.read_parquet_snapshots(spark, str(tmp_path), lake.TRANSIT_SOURCE)
    assert [tuple(r) for r in out.collect()] == [("x", "simplygo_tfm", dt.date(2024, 1, 1))]


def test_seed_booleans(spark, rows, tmp_path):
    path = tmp_path / "payee_flag.csv"
    path.write_text("payee_id,payee_name,is_unaccounted,is_passive\np1,Adjustment,1,0\np2,Bank,0,1\n")
    out = seeds.read_seed(spark, str(path), seeds.PAYEE_FLAG)
    assert out.schema["is_passive"].dataType.typeName() == "boolean"
    assert rows(out) == [("p1", "Adjustment", True, False), ("p2", "Bank", False, True)]


def test_newest_export_is_not_the_last_name(spark, rows):
    names = ["x/ACC_TXN_History_31012023.xls", "x/ACC_TXN_History_01022024.xls", "x/ACC_TXN_History_01022024110000.xls"]
    files = spark.createDataFrame([(n, i) for i, n in enumerate(names) for _ in range(2)], "file string, i int")
    got = statements.newest_export(files)
    assert rows(got, "file", "date") == [("x/ACC_TXN_History_01022024110000.xls", dt.date(2024, 2, 1))] * 2


def card(type_="Journey", transaction="CTP Bus Usage Mtch", token="tok-7"):
    return {
        "UniqueCode": "C-88",
        "Description": "Blue card",
        "transactions": {"Histories": [
            {"Type": type_, "TokenID": token, "EntryLocationId": "N9", "EntryTransactionDate": "2023-05-02T07:30:00Z",
             "Trips": [
                 {"TransactionType": transaction, "EntryTransactionDate": "2023-05-02T07:30:00Z", "Fare": "$2.17",
                  "EntryLocationName": "Harbour", "ExitLocationName": "Old Mill"},
                 {"TransactionType": "CTP Rail Usage Mtch", "EntryTransactionDate": "2023-05-01T18:05:00Z",
                  "Fare": "Pass Usage", "EntryLocationName": "Old Mill", "ExitLocationName": "Airport"},
             ]},
            {"Type": "Top-up", "Trips": []},
        ]},
    }


def legs_of(spark, tmp_path, *cards):
    path = tmp_path / "out.json"
    path.write_text(json.dumps(list(cards), indent=1))
    return journeys.journey_legs(journeys.read_cards(spark, str(path)), dt.datetime(2023, 5, 3, 6))


def test_journeys_to_legs(spark, rows, tmp_path):
    legs = legs_of(spark, tmp_path, card(), card(type_="Refund"))
    assert rows(legs.drop("traveled_on")) == [
        ("C-88", "Blue card", "2.17", "2023-05-03 06:00:00", "Harbour", "Old Mill",
         "tok-7_N9_2023-05-02T07:30:00Z", "Bus", ""),
        ("C-88", "Blue card", "Pass Usage", "2023-05-03 06:00:00", "Old Mill", "Airport",
         "tok-7_N9_2023-05-02T07:30:00Z", "Rail", ""),
    ]
    staged = staging.stg_trip_leg(legs)
    assert rows(staged, "cost_sgd", "traveled_on", "posting_ref") == [
        (Decimal("0E-7"), dt.datetime(2023, 5, 1, 18, 5), None),
        (Decimal("2.1700000"), dt.datetime(2023, 5, 2, 7, 30), None),
    ]
    assert rows(staging.stg_card(legs), "id", "name") == [("C-88", "Blue card")]


def test_missing_trip_id_part_is_spelled_out(spark, tmp_path):
    assert legs_of(spark, tmp_path, card(token=None)).first()["trip_id"] == "None_N9_2023-05-02T07:30:00Z"


def test_unknown_transport_mode_fails(spark, tmp_path):
    with pytest.raises(PySparkException, match="no transport mode"):
        legs_of(spark, tmp_path, card(transaction="Taxi")).collect()


def test_late_window_looks_either_way(spark, rows):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 23),) for d in range(1, 10)], "ts timestamp_ntz")
    days = lambda n: [r[0].day for r in rows(incremental.late_window(df, "ts", dt.date(2024, 1, 4), n))]
    assert days(3) == [4, 5, 6, 7]
    assert days(-2) == [2, 3, 4]


def test_merge_days_touches_only_arrived_days(spark, rows):
    schema = "id string, day date, v int"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    current = spark.createDataFrame([("a", d1, 1), ("b", d1, 1), ("c", d2, 1)], schema)
    arrived = spark.createDataFrame([("a", d1, 2), ("d", d1, 1), ("b", d1, 0)], schema)
    out = incremental.merge_days(current, arrived, ["id"], "day", "v", [])
    assert out.columns == current.columns
    assert rows(out) == [("a", d1, 2), ("b", d1, 1), ("d", d1, 1)]


def test_models_as_catalog_table_and_view(spark, rows):
    lake.save_as_table(spark.range(3), "tallyhouse_test_table")
    lake.save_as_table(spark.range(2), "tallyhouse_test_table")  # rebuilt whole
    try:
        lake.expose_as_view(spark.table("tallyhouse_test_table").filter("id > 0"), "tallyhouse_test_view")
        assert rows(spark.sql("select * from tallyhouse_test_view")) == [(1,)]
    finally:
        spark.sql("drop table tallyhouse_test_table")


def test_documents_at_fault_are_put_aside(spark, rows, tmp_path):
    sound = '{"data":{"budget":{"id":"b1","accounts":[{"id":"a1"},{"id":"a2","colour":"red"}],"theme":1},"server_knowledge":4}}'
    lines = [
        sound,
        "",
        sound[:-5],
        '{"data":{"budget":{"name":"none"}}}',
        '{"data":{"budget":{"id":"b2","accounts":[{"id":"a3","closed":"perhaps"}]}}}',
        "[1, 2]",
        '{"data":{"budget":{"id":"b3","accounts":[]}}}',
    ]
    text = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    text.write.text(str(tmp_path / f"by={lake.BUDGET_SOURCE}" / "date=2024-01-01"))
    raw = budget.read_raw(spark, str(tmp_path), lines=True)
    documents = budget.checked(raw, "accounts")
    assert rows(budget.sound(documents).select("data.budget.id", F.size("data.budget.accounts"))) == [("b1", 2), ("b3", 0)]
    aside = rows(budget.quarantine(documents), "reason", "value")
    at_fault = [(budget.UNREADABLE, lines[2]), (budget.NO_BUDGET, lines[3]), (budget.UNREADABLE, lines[4]), (budget.UNREADABLE, lines[5])]
    assert aside == sorted(at_fault, key=repr)
    assert rows(budget.unknown_fields(raw, "accounts")) == [("accounts.colour", 1), ("theme", 1)]


def test_documents_are_written_compressed_in_bounded_files(spark, monkeypatch):
    import gzip
    import os

    from workload import queries

    monkeypatch.setattr(queries, "FILE_DOCUMENTS", 3)
    root = queries._order_documents(spark, "/root/testdata/sf0.001")
    files = [os.path.join(d, f) for d, _, names in os.walk(root.removeprefix("file://")) for f in names if f.startswith("part-")]
    counts = [len(gzip.open(f).read().splitlines()) for f in files]
    assert all(f.endswith(".gz") for f in files) and max(counts) <= 3
    assert sum(counts) == budget.read_raw(spark, root, lines=True).count() > 3


def test_documents_are_gathered_in_one_exchange_of_each_table(spark, rows):
    from workload import queries

    text = queries._order_texts(spark, "/root/testdata/sf0.001")
    assert text._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    root = queries._order_documents(spark, "/root/testdata/sf0.001")
    read = spark.read.text(root + "/by=*").select("value")
    keys = rows(read.select(F.get_json_object("value", "$.data.server_knowledge")))
    assert len(keys) == text.count() == text.distinct().count()


def test_files_are_moved_under_new_names(spark, tmp_path):
    from tallyhouse.session import move_files

    (tmp_path / "a").mkdir()
    for name in ("x.gz", "_SUCCESS", ".x.crc"):
        (tmp_path / "a" / name).write_text(name)
    for n in (1, 2):
        move_files(spark, str(tmp_path / "a"), str(tmp_path / "b/c"), f"{n}-")
        (tmp_path / "a" / "x.gz").write_text("y")
    move_files(spark, str(tmp_path / "none"), str(tmp_path / "b/c"))
    assert sorted(p.name for p in (tmp_path / "b/c").iterdir() if p.name[0] != ".") == ["1-x.gz", "2-x.gz"]
