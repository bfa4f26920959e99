"""Money helpers: exact decimals throughout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 7)
MONEY_SUM = DecimalType(38, 7)


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Exact sum with one width whatever the input's width is."""
    return F.sum(_col(c)).cast(MONEY_SUM)


def from_milliunits(c: Column | str) -> Column:
    return (_col(c).cast("decimal(18,0)") / F.lit(1000)).cast(MONEY)


def to_int(c: Column | str) -> Column:
    """Integer nearest to a decimal, halves away from zero (a bare cast would truncate)."""
    return F.round(_col(c), 0).cast("int")


def to_milliunits(c: Column | str) -> Column:
    return to_int(_col(c) * F.lit(1000))


def ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Quotient as double; NULL when the denominator is zero or NULL."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), digits)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
