"""Public-transport journeys: cards with journeys with legs, to one row per leg."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.text import strip_currency_sign, transport_mode

# Fields of the transit export.
LEG = (
    "TransactionType string, EntryTransactionDate string, Fare string, EntryLocationName string,"
    " ExitLocationName string"
)
JOURNEY = (
    "Type string, TokenID string, EntryLocationId string, EntryTransactionDate string,"
    f" Trips array<struct<{LEG}>>"
)
CARD_SCHEMA = (
    f"UniqueCode string, Description string, transactions struct<Histories array<struct<{JOURNEY}>>>"
)
JOURNEY_TYPE = "Journey"


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """Card documents; each file holds a list of them."""
    return spark.read.schema(CARD_SCHEMA).option("multiLine", True).json(path)


def card_documents(text: Column) -> Column:
    """The same documents from a column of JSON text."""
    return F.from_json(text, f"array<struct<{CARD_SCHEMA}>>")


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def journey_legs(cards: DataFrame, scraped_on: dt.datetime) -> DataFrame:
    """One row per leg of every journey. Records of other types are left out; a leg whose
    type does not name a transport mode fails the job."""
    journeys = cards.select(
        F.col("UniqueCode").alias("card_id"),
        F.col("Description").alias("card_name"),
        F.inline("transactions.Histories"),
    ).filter(F.col("Type") == JOURNEY_TYPE)
    trip_id = F.concat_ws("_", _text("TokenID"), _text("EntryLocationId"), _text("EntryTransactionDate"))
    legs = journeys.select("card_id", "card_name", trip_id.alias("trip_id"), F.inline("Trips"))
    return legs.select(
        "card_id",
        "card_name",
        strip_currency_sign("Fare").alias("cost_sgd"),
        F.lit(scraped_on.strftime("%Y-%m-%d %H:%M:%S")).alias("scraped_on"),
        F.col("EntryLocationName").alias("source"),
        F.col("ExitLocationName").alias("destination"),
        "trip_id",
        transport_mode("TransactionType").alias("mode"),
        F.col("EntryTransactionDate").alias("traveled_on"),
        F.lit("").alias("posting_ref"),
    )
