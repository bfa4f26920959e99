"""Bank-statement exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.text import base_name, export_date
from tallyhouse.operators.reports import SheetLayout, extract_sheets


def with_export_date(files: DataFrame, path: str = "file") -> DataFrame:
    """Add the day of export, read from the file name, as ``date``."""
    return files.withColumn("date", export_date(base_name(path)))


def newest_export(files: DataFrame, path: str = "file") -> DataFrame:
    """Rows of the export with the latest day in its name (not the last name in text order).

    Several files of one day are ordered by name.
    """
    dated = with_export_date(files, path)
    newest = dated.agg(F.max(F.struct("date", path)).getField(path).alias("_newest"))
    return dated.join(newest, F.col(path) == F.col("_newest"), "left_semi")


def stage_statements(grid: DataFrame, layout: SheetLayout = SheetLayout()) -> DataFrame:
    """Typed statement rows of many export grids with their export day."""
    return with_export_date(extract_sheets(grid, layout))
