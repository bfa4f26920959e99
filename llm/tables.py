"""Written intermediates, components of a link table, and runs of equal keys in a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.session import scratch_dir


def shipped(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let Python workers import this package from where the driver has it, whatever their working folder.

    That serves executors which see the driver's files; on others, ship the package with the job.
    ``run`` takes the session first.
    """

    @wraps(run)
    def query(spark: SparkSession, *args) -> DataFrame:
        here, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
        paths = known.get("PYTHONPATH", "").split(":")
        if here not in paths:
            known["PYTHONPATH"] = ":".join([here, *filter(None, paths)])
        return run(spark, *args)

    return query


def store(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write to a fresh shared folder and read again: lineage ends there, and sizes are known.

    ``batch_rows`` bounds the rows that Python workers get at once while this is written, for rows
    that may be large; Spark's own bound is meant for small ones.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        if batch_rows:
            spark.conf.set(name, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
        df.write.parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b): the smallest id that it reaches.

    Alternating large-star and small-star steps. Each writes its links, whose number never
    grows; minima are combined before the shuffle, and the joins are inner equi-joins, which
    adaptive execution splits at hot ids.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = store(edges, "links")
    mark = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u > v")
            .distinct()
        )
        edges = store(small, "links")
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sums) == mark:
            break
        mark = tuple(sums)
    heads = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).union(heads)


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Groups of neighbouring rows with equal non-null integer keys, out of sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [*np.flatnonzero(new), batch.num_rows]
        at = 0
        head = tuple(c[0] for c in columns)
        if held and head != last:
            yield pa.Table.from_batches(held)
            held = []
        for cut in cuts:
            held.append(batch.slice(at, cut - at))
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
            at = cut
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
