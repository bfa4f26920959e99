"""Sums over a corpus-wide table for the items of many rows, with hot items kept out of the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MOST_HEAVY = 1 << 14


def sums_by_row(items: DataFrame, values: DataFrame, total: int, **sums: Column) -> DataFrame:
    """(row, sums...) over items (row, key, n) that meet values (key, weight, ...), whose keys are unique.

    ``total`` is at least the sum of the non-negative weights. So at most MOST_HEAVY keys hold a
    share of 1 / MOST_HEAVY of it or more: these are broadcast, and their items summed up before
    the shuffle. No other key is hot by weight.
    """
    heavy = F.col("weight") * MOST_HEAVY >= F.lit(total)
    top = F.broadcast(values.filter(heavy).withColumn("heavy", F.lit(True)))
    rest = values.filter(~heavy)
    direct = items.join(top, "key").drop("heavy")
    others = items.join(top.select("key"), "key", "left_anti").join(rest, "key")
    return direct.unionByName(others).groupBy("row").agg(*(c.alias(name) for name, c in sums.items()))
