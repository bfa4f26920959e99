"""History-keeping (type 2) dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.functions.dates import ts_max


def with_validity(df: DataFrame, key: str, effective: str) -> DataFrame:
    """Add ``effective_at``, ``expired_at`` and ``is_current``.

    A row expires when the key's next row takes effect. Input must hold one row per
    (key, effective day), so the rows in a key's window are bounded by the calendar,
    not by the data.
    """
    following = F.lead(effective).over(Window.partitionBy(key).orderBy(F.col(effective).asc_nulls_last()))
    return (
        df.withColumn("effective_at", F.col(effective).cast("timestamp_ntz"))
        .withColumn("expired_at", F.coalesce(following.cast("timestamp_ntz"), ts_max()))
        .withColumn("is_current", F.col("expired_at") == ts_max())
    )
