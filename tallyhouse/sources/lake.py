"""Partitioned snapshot folders ``<root>/by=<source>/date=<day>`` and model tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Folder names of the three sources in an existing lake.
BUDGET_SOURCE = "ynab"
TRANSIT_SOURCE = "simplygo_tfm"
BANK_SOURCE = "uob"
PARQUET_FILES = "*.{pq,parquet}"


def read_json_snapshots(
    spark: SparkSession,
    root: str,
    schema: StructType | str,
    source: str = BUDGET_SOURCE,
    lines: bool = False,
) -> DataFrame:
    """JSON documents of all days: one per file, or one per line of splittable files.

    Fields a document lacks are NULL; fields that the schema lacks are skipped by the
    parser, so pass only what is needed.
    """
    reader = spark.read.schema(schema).option("multiLine", not lines).option("basePath", root)
    return reader.json(f"{root}/by={source}")


def read_parquet_snapshots(
    spark: SparkSession, root: str, source: str, schema: StructType | str | None = None
) -> DataFrame:
    """Parquet rows of all days, with ``by`` and ``date`` from the path."""
    reader = spark.read.option("basePath", root).option("pathGlobFilter", PARQUET_FILES)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root}/by={source}")


def stage_snapshots(df: DataFrame, root: str, source: str) -> None:
    """Replace the days that occur in ``df`` (column ``date``); an empty frame changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(f"{root}/by={source}")
    )


def land_snapshots(df: DataFrame, root: str, source: str, scraped_at: str = "scraped_at") -> None:
    """Append snapshots, of which a day may have several, told apart by ``scraped_at``."""
    (
        df.withColumn("date", F.to_date(scraped_at))
        .write.mode("append")
        .partitionBy("date")
        .parquet(f"{root}/by={source}")
    )


@dataclass(frozen=True)
class TableStore:
    """Model tables as Parquet folders, rebuilt whole on every run."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        # keys are hashes in hex, which need half the bytes under a codec with entropy coding
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
        writer.parquet(self.path(name))
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def save_as_table(df: DataFrame, name: str) -> None:
    """Rebuild a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def expose_as_view(df: DataFrame, name: str) -> None:
    """Name a frame for SQL without computing it."""
    df.createOrReplaceTempView(name)
