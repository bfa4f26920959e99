"""First row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def newest(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def oldest(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one whole row per key: the first in ``order``.

    ``row_number() = 1`` lets Spark put a per-task group limit below the shuffle,
    so each task sends at most one row per key. A key that holds a third of the
    input therefore reaches its final task as one row per input task.
    Give a total order, or ties are broken arbitrarily.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str = "scraped_on", ties: Sequence[str] = ()
) -> DataFrame:
    """Newest version of every entity; ``ties`` (ascending) decide between equal versions."""
    return first_per_key(df, keys, [newest(version), *map(oldest, ties)])


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], version: str = "scraped_on", ties: Sequence[str] = ()
) -> DataFrame:
    return first_per_key(df, keys, [oldest(version), *map(oldest, ties)])


def without(df: DataFrame, *names: str) -> DataFrame:
    """All columns but the named ones."""
    return df.drop(*names)


def dev_limit(df: DataFrame, target: str = "prod", n_rows: int = 100) -> DataFrame:
    """Row limit for development runs; production frames pass unchanged."""
    return df.limit(n_rows) if target == "dev" else df
