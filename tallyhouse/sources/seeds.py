"""Seed tables: small hand-kept CSV files with declared column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Declared types; booleans are written as 0/1.
PAYEE_FLAG = {"payee_id": "string", "payee_name": "string", "is_unaccounted": "boolean", "is_passive": "boolean"}
ACCOUNT_MAP = {"budget_account_id": "string", "vendor": "string", "vendor_id": "string"}
CARD_MAP = {"bank_card_id": "string", "vendor": "string", "vendor_id": "string"}


def read_seed(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Read a CSV seed. Spark's CSV reader makes NULL of 0/1 booleans, so these are read as integers."""
    schema = ", ".join(f"{name} {'int' if kind == 'boolean' else kind}" for name, kind in columns.items())
    raw = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return raw.select([F.col(name).cast(kind).alias(name) for name, kind in columns.items()])
