"""Ranks within keys that one task need not see whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.session import scratch_dir


def rank_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "_rank") -> DataFrame:
    """Number the rows of every key from 1 in ``order``; NULL is a key like others.

    Rows are dealt over tasks by ranges of (keys, order), numbered inside a range, and shifted by
    the rows that the key has in the ranges before. So a key with a third of all rows is numbered
    by a third of the tasks. The ranges are written once, since the bounds are drawn from a sample.
    Rows that tie in ``order`` stay in one range.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "ranges")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    shifts = counts.select(
        *(F.col(k).alias(f"_of_{k}") for k in keys), F.col("_range").alias("_in"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    own = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return (
        dealt.withColumn("_own", own)
        .join(shifts, [*same, F.col("_range") == F.col("_in")])
        .select(*df.columns, (F.col("_shift") + F.col("_own")).alias(name))
    )
