"""Parsing of the text fields found in exports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyhouse.functions.money import MONEY

# Formats of the source systems.
MODE_PATTERN = r"^CTP (\w+) Usage Mtch"
PASS_FARE = "Pass Usage"
EXPORT_NAME_PATTERN = r"^ACC_TXN_History_(\d{2})(\d{2})(\d{4})\d*\."
PERIOD_SEPARATOR = " To "
STATEMENT_DATE_FORMAT = "dd MMM yyyy"


def require_match(value: Column, pattern: str, group: int, message: str) -> Column:
    """A regex group; the job fails on text that does not match."""
    return F.when(
        F.coalesce(F.regexp_like(value, F.lit(pattern)), F.lit(False)),
        F.regexp_extract(value, pattern, group),
    ).otherwise(F.raise_error(F.concat(F.lit(message + ": "), F.coalesce(value, F.lit("NULL")))))


def transport_mode(transaction_type: Column | str) -> Column:
    return require_match(_col(transaction_type), MODE_PATTERN, 1, "no transport mode in transaction type")


def strip_currency_sign(fare: Column | str) -> Column:
    return F.replace(_col(fare), F.lit("$"), F.lit(""))


def fare_amount(fare: Column | str) -> Column:
    """Fare text as money: rides on a pass cost nothing, unreadable text becomes NULL."""
    return F.when(_col(fare) == PASS_FARE, F.lit(0).cast(MONEY)).otherwise(
        strip_currency_sign(fare).try_cast(MONEY)
    )


def export_date(file_name: Column | str) -> Column:
    """Day an export was made, from ``ACC_TXN_History_<DDMMYYYY>...``."""
    name = _col(file_name)
    day, month, year = (
        require_match(name, EXPORT_NAME_PATTERN, g, "not an export file name").cast("int") for g in (1, 2, 3)
    )
    return F.make_date(year, month, day)


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def statement_day(text: Column | str) -> Column:
    return F.to_date(_col(text), STATEMENT_DATE_FORMAT)


def statement_period(text: Column | str) -> tuple[Column, Column]:
    """First and last day of ``'06 Feb 2023 To 07 Apr 2023'`` as timestamps."""
    parts = F.split(_col(text), PERIOD_SEPARATOR)
    return tuple(F.to_date(F.get(parts, i), STATEMENT_DATE_FORMAT).cast("timestamp_ntz") for i in (0, 1))


def blank_to_null(c: Column | str) -> Column:
    return F.when(_col(c) != "", _col(c))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
