"""Extraction of sectioned sheets (a metadata block above a table) from cell grids.

A grid holds the cells of many files: ``(file, row_no, c0, c1, ...)``, all text.
``row_no`` starts at 0 below the row that a sheet reader consumes as its header.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class SheetLayout:
    """Where the parts of a sheet are and what the result looks like."""

    # Layout of a bank-statement export. The block's first row is not reported.
    first_metadata_row: int = 3
    last_metadata_row: int = 5
    currency_row: int = 3
    currency_column: str = "c2"
    header_row: int = 6
    metadata: tuple[str, ...] = ("Account Number", "Account Type", "Statement Period")
    columns: Mapping[str, str] = field(
        default_factory=lambda: {
            "Transaction Date": "string",
            "Transaction Description": "string",
            "Withdrawal": "double",
            "Deposit": "double",
            "Available Balance": "double",
        }
    )


def cells(grid: DataFrame) -> list[str]:
    return [c for c in grid.columns if c not in ("file", "row_no")]


def sheet_heads(grid: DataFrame, layout: SheetLayout) -> DataFrame:
    """One row per file: metadata values, currency and the table's header names.

    Only the few rows above the table are read into this aggregation. It sorts, as its values are
    texts, so its rows are dealt out by file first: a task that reads many files would sort them all.
    """
    row, c0, c1 = F.col("row_no"), F.col("c0"), F.col("c1")
    in_block = row.between(layout.first_metadata_row, layout.last_metadata_row)

    def pick(condition: Column, value: Column) -> Column:
        return F.max(F.when(condition, value))

    return (
        grid.filter(row <= layout.header_row)
        .repartition("file")
        .groupBy("file")
        .agg(
            *[pick(in_block & (F.btrim(c0, F.lit(":")) == key), c1).alias(key) for key in layout.metadata],
            pick(row == layout.currency_row, F.col(layout.currency_column)).alias("Currency"),
            *[pick(row == layout.header_row, F.col(c)).alias("head_" + c) for c in cells(grid)],
        )
    )


def extract_sheets(grid: DataFrame, layout: SheetLayout = SheetLayout()) -> DataFrame:
    """One typed row per table row of every file, with the file's metadata on it.

    Columns are found by header name, so their order may differ between files; a file
    without one of the names fails the job.
    """
    heads = sheet_heads(grid, layout)
    names = cells(grid)

    def has(name: str) -> Column:
        return F.coalesce(*[F.when(F.col("head_" + c) == name, F.lit(True)) for c in names], F.lit(False))

    def cell(name: str) -> Column:
        return F.coalesce(*[F.when(F.col("head_" + c) == name, F.col(c)) for c in names])

    complete = F.when(reduce(and_, map(has, layout.columns)), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("missing table column in "), F.col("file")))
    )
    return (
        grid.filter(F.col("row_no") > layout.header_row)
        .join(heads, "file")
        .filter(complete)
        .select(
            "file",
            *[cell(name).cast(kind).alias(name) for name, kind in layout.columns.items()],
            *layout.metadata,
            "Currency",
        )
    )
