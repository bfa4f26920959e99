"""Unnesting of document arrays into rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def unnest(df: DataFrame, array: Column | str, keep: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per struct of ``array``, its fields as columns, beside the ``keep`` columns."""
    kept = [c.alias(name) for name, c in (keep or {}).items()]
    return df.select(*kept, F.inline(F.col(array) if isinstance(array, str) else array))
