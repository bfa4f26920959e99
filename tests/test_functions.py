"""Column helpers on literals, with DuckDB as the judge where both have the function."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.functions import dates, keys, money, text

DAYS = ["2021-01-01", "2020-12-31", "2024-02-29", "2023-10-01", "1999-12-27", "2019-01-06"]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("day", DAYS)
def test_date_parts_match_duckdb(spark, day):
    d = F.lit(day).cast("date")
    got = spark.range(1).select(
        F.weekofyear(d), F.quarter(d), dates.day_of_week(d), dates.week_start(d), dates.month_start(d),
        F.date_format(d, "EEEE"), F.date_format(d, "MMM"), dates.add_years(d, 20), dates.is_weekend(d),
    ).first()
    want = duckdb.connect().execute(
        f"""select week(d), quarter(d), dayofweek(d), date_trunc('week', d)::date, date_trunc('month', d)::date,
                   strftime(d, '%A'), strftime(d, '%b'), (d + interval 20 year)::date, dayofweek(d) in (0, 6)
            from (select date '{day}' as d)"""
    ).fetchall()[0]
    assert tuple(got) == tuple(want)


@pytest.mark.parametrize("amount", ["1234.5", "-1234.5", "0.4999999", "-0.5", "2.5"])
def test_decimal_to_int_rounds_half_away_from_zero(spark, amount):
    got = one(spark, money.to_int(F.lit(amount).cast(money.MONEY)))
    want = duckdb.connect().execute(f"select cast(cast('{amount}' as decimal(18,7)) as integer)").fetchall()[0][0]
    assert got == want


def test_milliunits_round_trip(spark):
    assert one(spark, money.from_milliunits(F.lit(-12345))) == Decimal("-12.3450000")
    assert one(spark, money.to_milliunits(F.lit("-12.345").cast(money.MONEY))) == -12345


def test_ratio_of_nothing_is_null(spark):
    assert one(spark, money.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, money.ratio(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, money.ratio(F.lit(1), F.lit(4))) == 0.25


def test_surrogate_key_matches_duckdb(spark):
    got = one(
        spark,
        keys.surrogate_key(
            F.lit("a"), F.lit(None).cast("string"), F.lit("2024-02-29").cast("date"),
            F.lit("2024-02-29 01:02:03").cast("timestamp_ntz"), F.lit("1.50").cast("decimal(18,2)"),
        ),
    )
    want = duckdb.connect().execute(
        """select md5(concat_ws('-', 'a', '_dbt_utils_surrogate_key_null_', date '2024-02-29',
                                timestamp '2024-02-29 01:02:03', cast('1.50' as decimal(18,2))))"""
    ).fetchall()[0][0]
    assert got == want


def test_import_id(spark):
    got = one(spark, keys.import_id(F.lit("e1")))
    assert got == duckdb.connect().execute("select left(sha256('pvde1'), 36)").fetchall()[0][0]
    assert len(got) == 36


def test_scrape_times(spark):
    assert one(spark, dates.scraped_on(F.lit("2024-01-02").cast("date"))) == dt.datetime(2024, 1, 2)
    assert one(spark, dates.scraped_on(F.lit(None).cast("date")).cast("string")).startswith("0001-01-01")
    assert one(spark, dates.ts_max().cast("string")) == "9999-12-31 23:59:59"
    for hours, gone in ((48, False), (49, False), (72, True)):
        scraped = F.lit(str(dt.datetime(2024, 1, 10, 23) - dt.timedelta(hours=hours))).cast("timestamp_ntz")
        assert one(spark, dates.presumed_deleted(scraped, dt.date(2024, 1, 10))) is gone


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_singapore_time_does_not_depend_on_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, dates.singapore_to_utc(F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")))
        assert got == dt.datetime(2024, 3, 9, 18, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "fare, amount", [("$1.50", Decimal("1.5")), ("Pass Usage", Decimal(0)), ("2", Decimal(2)), ("free", None)]
)
def test_fares(spark, fare, amount):
    assert one(spark, text.fare_amount(F.lit(fare))) == amount


@pytest.mark.parametrize(
    "name, day",
    [
        ("ACC_TXN_History_05062024124137.xls", dt.date(2024, 6, 5)),
        ("ACC_TXN_History_05062024355224.xls", dt.date(2024, 6, 5)),
        ("ACC_TXN_History_05062024.xls", dt.date(2024, 6, 5)),
        ("ACC_TXN_History_05072022.xls", dt.date(2022, 7, 5)),
    ],
)
def test_export_dates(spark, name, day):
    assert one(spark, text.export_date(F.lit(name))) == day


@pytest.mark.parametrize("name", ["ACC_TXN_History_0506.xls", "statement.xls", "x_ACC_TXN_History_05062024.xls", None])
def test_other_export_names_fail(spark, name):
    with pytest.raises(PySparkException, match="not an export file name"):
        one(spark, text.export_date(F.lit(name).cast("string")))


def test_transport_mode(spark):
    assert one(spark, text.transport_mode(F.lit("CTP Bus Usage Mtch"))) == "Bus"
    with pytest.raises(PySparkException, match="no transport mode"):
        one(spark, text.transport_mode(F.lit("Top-up")))


def test_statement_period(spark):
    begin, end = text.statement_period(F.lit("06 Feb 2023 To 07 Apr 2023"))
    assert one(spark, begin) == dt.datetime(2023, 2, 6)
    assert one(spark, end) == dt.datetime(2023, 4, 7)
