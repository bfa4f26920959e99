"""Incremental pickup of snapshot files, and late data.

Snapshots are landed append-only and exactly once; the newest version of an entity is
chosen when they are read, so a late or repeated scrape needs no update in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyhouse.operators.dedupe import first_per_key, oldest
from tallyhouse.session import drop_dir as _drop, scratch_dir
from tallyhouse.sources.budget import document_schema
from tallyhouse.sources.incremental import merge_days
from tallyhouse.sources.lake import BUDGET_SOURCE
from tallyhouse.sources.versioned import PartTable, by_bucket


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    pattern: str = "*.{pq,parquet}",
    max_files: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; each file is picked up once per checkpoint."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def without_repeats(
    stream: DataFrame, event_time: str, keys: Sequence[str], late_by: str = "3 days"
) -> DataFrame:
    """Drop rows whose keys were seen before, up to ``late_by`` behind the newest row.

    Kept state is bounded by the window, not by the length of the stream. Watermarks need
    an instant, so wall-clock event times are read as UTC for it.
    """
    wall_clock = F.col(event_time).cast("string")
    instant = F.to_timestamp_ltz(F.concat(wall_clock, F.lit("+00:00")))
    return (
        stream.withColumn("_event_time", instant)
        .withWatermark("_event_time", late_by)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("_event_time")
    )


def land_newest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    day: str,
    version: str,
    ties: Sequence[str] = (),
) -> None:
    """Keep the newest version per key at ``path``, partitioned by ``day``, until the stream has no more.

    A batch rewrites the days that it touches, however late they come. The merged days are
    written aside before they replace what they were read from, and a batch that is run again
    finds its own rows and changes nothing.
    """
    spark, schema = stream.sparkSession, stream.schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        current = spark.read.schema(schema).parquet(path)
        merged = merge_days(current, batch, list(keys), day, version, list(ties))
        aside = scratch_dir(spark, "merge")
        merged.write.parquet(aside)
        written = spark.read.schema(schema).parquet(aside)
        _days(written, day).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    _days(spark.createDataFrame([], schema), day).mode("append").parquet(path)  # a first batch has something to read
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


def _days(df: DataFrame, day: str) -> DataFrameWriter:
    return df.hint("rebalance", day).write.partitionBy(day)  # a hot day is split by its size


def merge_newest(
    stream: DataFrame, table: PartTable, checkpoint: str, keys: Sequence[str], newest: str, ties: Sequence[str] = ()
) -> None:
    """Merge every batch into a table of replaceable parts, until the stream has no more.

    A batch is one published version of the table: readers see all of it or nothing, and a batch
    that is run again changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, keys, newest, ties, version=batch_id + 1)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


@dataclass(frozen=True)
class Merged:
    """A table kept from documents: how a batch of them is staged, where it goes, and its keys."""

    stage: Callable[[DataFrame], DataFrame]
    table: PartTable
    keys: tuple[str, ...]


CURSOR = "budget_id string, server_knowledge bigint"


def budget_stream(spark: SparkSession, root: str, *entities: str, source: str = BUDGET_SOURCE) -> DataFrame:
    """Budget documents, one per line, as they arrive in the day folders of a lake."""
    schema = f"{document_schema(*entities)}, date date"
    return spark.readStream.schema(schema).json(f"{root}/by={source}")


def cursor_table(spark: SparkSession, root: str) -> PartTable:
    """The newest mark of every budget."""
    return PartTable(spark, root, StructType.fromDDL(CURSOR), by_bucket(["budget_id"], 1))


def merge_documents(stream: DataFrame, tables: Sequence[Merged], cursor: PartTable, checkpoint: str) -> None:
    """Merge the arrays of arriving documents into their tables, until the stream has no more.

    Documents that aren't beyond their budget's mark are skipped; those without a mark are taken.
    Every table, and at last the cursor, publishes a batch once and whole. So a batch that is lost
    on its way is finished by its next run: what was published stays, and the mark has not moved.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        marks = cursor.read().select(F.col("budget_id").alias("_budget"), F.col("server_knowledge").alias("_mark"))
        told = F.col("data.server_knowledge")
        fresh = batch.join(marks, F.col("data.budget.id") == F.col("_budget"), "left").filter(
            F.col("_mark").isNull() | told.isNull() | (told > F.col("_mark"))
        )
        fresh = fresh.select(*batch.columns)
        for merged in tables:
            merged.table.merge(merged.stage(fresh), merged.keys, "scraped_on", version=batch_id + 1)
        moved = fresh.groupBy(F.col("data.budget.id").alias("budget_id")).agg(F.max(told).alias("server_knowledge"))
        cursor.merge(moved.filter("server_knowledge is not null"), ["budget_id"], "server_knowledge", version=batch_id + 1)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


def land_with_late(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], event_time: str, late_by: str = "3 days"
) -> None:
    """Land each key once, and what comes too late apart, until the stream has no more.

    A row is late if it is more than ``late_by`` behind the newest row landed by the batches before,
    or has no event time; every late row is landed, repeats included. Of the others a key is landed at
    its first arrival (within a batch: its earliest row), and its repeats are dropped. The keys
    landed within the window are kept as a table per batch, so the state is as large as the window.
    ``landed`` and ``late`` read the two outputs. A batch that is run again overwrites its own rows.
    """
    spark, schema = stream.sparkSession, stream.schema
    kept = [*keys, event_time]
    state_schema, kind = StructType([schema[c] for c in kept]), schema[event_time].dataType

    def state_path(batch_id: int) -> str:
        return f"{path}/state/{batch_id}"

    def window_start(rows: DataFrame) -> Column:
        """As a literal; before the first row nothing is too late."""
        start = (F.max(event_time) - F.expr(f"interval {late_by}")).cast("string")
        return F.coalesce(F.lit(rows.agg(start).first()[0]).cast(kind), F.lit("0001-01-01").cast(kind))

    def split(batch: DataFrame, batch_id: int) -> None:
        if batch_id:
            state = spark.read.schema(state_schema).parquet(state_path(batch_id - 1))
        else:
            state = spark.createDataFrame([], state_schema)
        time = F.col(event_time)
        late = time.isNull() | (time < window_start(state))
        known = state.select(*(F.col(c).alias(f"_{c}") for c in keys)).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
        order = [oldest(event_time), *(oldest(c) for c in schema.names if c not in kept)]
        fresh = first_per_key(batch.filter(~late).join(known, same, "left_anti"), keys, order)
        told = fresh.withColumn("_kind", F.lit("landed")).unionByName(batch.filter(late).withColumn("_kind", F.lit("late")))
        told.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("_kind", "_batch").parquet(f"{path}/rows")

        now = _of_kind(spark, path, schema, "landed").filter(F.col("_batch") == batch_id).select(*kept)
        both = state.unionByName(now)
        both.filter(time >= window_start(both)).write.mode("overwrite").parquet(state_path(batch_id))
        _drop(spark, state_path(batch_id - 2))

    stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


def _of_kind(spark: SparkSession, path: str, schema: StructType, kind: str) -> DataFrame:
    told = StructType([*schema, StructField("_kind", StringType()), StructField("_batch", IntegerType())])
    return spark.read.schema(told).parquet(f"{path}/rows").filter(F.col("_kind") == kind)


def landed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows that ``land_with_late`` has landed in time."""
    return _of_kind(spark, path, schema, "landed").select(*schema.names)


def late(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows that came too late, and the batch that brought them."""
    return _of_kind(spark, path, schema, "late").select(*schema.names, F.col("_batch").alias("batch"))


def land(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Append everything that has arrived since the last run, then stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(path).awaitTermination()
