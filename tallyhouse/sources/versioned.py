"""Tables of which parts (days, or buckets of keys) are replaced whole or merged into, all at once.

New content of some parts goes into a folder of its own. It counts once one small file in the
table's log names it; readers take, of each part, the newest whole content that the log names and
the merged rows after it, of which the newest of a key counts. So a run that is lost on its way leaves
the old table, and a reader never meets a mix of both. One writer at a time; what newer content has
replaced stays on disk until its owner expires it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators.dedupe import latest_per_key
from tallyhouse.session import drop_dir, scratch_dir

# ``merged``: how rows that were merged are made unique; NULL for whole content
_LOG = "_part string, _version long, n_rows long, merged struct<keys array<string>, newest string, ties array<string>>"
MOST_MERGED = 8  # contents of a part that readers put together; the merge after that makes it whole


def by_day(column: str) -> Column:
    """Parts are days of a date or time, which a row must keep over its versions."""
    return F.date_format(column, "yyyy-MM-dd")


def by_bucket(keys: Sequence[str], n: int) -> Column:
    """Parts are ``n`` buckets of keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("string")


def _frozen(merged: Row | None) -> tuple | None:
    return (tuple(merged["keys"]), merged["newest"], tuple(merged["ties"])) if merged else None


@dataclass(frozen=True)
class PartTable:
    """A table at ``root``. ``part`` names a row's part in letters, digits and dashes; NULL is a part too.

    With ``few`` parts, any task may write to all of them; else merged rows are dealt out by part first.
    """

    spark: SparkSession
    root: str
    schema: StructType
    part: Column
    few: bool = False

    def _path(self, *names: object) -> str:
        return "/".join([self.root.rstrip("/"), *map(str, names)])

    def _log(self) -> DataFrame:
        self.spark.createDataFrame([], _LOG).write.mode("ignore").parquet(self._path("log"))
        return self.spark.read.schema(_LOG).parquet(self._path("log"))

    def tagged(self, df: DataFrame) -> DataFrame:
        """The table's columns, and the part of each row."""
        return df.select(*self.schema.names, F.coalesce(self.part, F.lit("none")).alias("_part"))

    def versions(self) -> DataFrame:
        """(_part, _version, n_rows, merged) of the content that counts."""
        whole = F.max(F.when(F.col("merged").isNull(), F.col("_version"))).over(Window.partitionBy("_part"))
        return self._log().withColumn("_whole", whole).filter("_whole is null or _version >= _whole").drop("_whole")

    def last(self) -> int:
        """Number of the newest published version; 0 before the first."""
        return self._log().agg(F.max("_version")).first()[0] or 0

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The table, or some parts of it. Only folders of content that counts are listed and read.

        Their names pass through the driver: a few per day of a calendar, or per bucket.
        """
        live = self.versions().filter("n_rows > 0")
        if parts is not None:
            live = live.filter(F.col("_part").isin(list(parts)))
        contents = live.collect()
        how = {r["_part"]: r["merged"] for r in contents if r["merged"]}  # all merged contents of a part agree
        paths: dict[tuple | None, list[str]] = {}
        for r in contents:
            path = self._path("data", f"_version={r['_version']}", f"_part={r['_part']}")
            paths.setdefault(_frozen(how.get(r["_part"])), []).append(path)
        if not paths:  # of known size, unlike a local list of rows
            return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema))
        frames = []
        for merged, some in paths.items():
            rows = self.spark.read.schema(self.schema).parquet(*some)
            frames.append(latest_per_key(rows, *merged) if merged else rows)
        return reduce(DataFrame.unionAll, frames)

    def replace(self, df: DataFrame, version: int, parts: Sequence[str] = ()) -> None:
        """Give the parts that occur in ``df`` its rows as their content; other ``parts`` become empty.

        Versions count up from 1. A version that is already published changes nothing, so a run may
        be repeated. Hot parts are split over several tasks and files by their size.
        """
        if version <= self.last():
            return
        counts = self._write(self.tagged(df).hint("rebalance", "_part"), version)
        emptied = self.spark.createDataFrame([(p,) for p in parts], "_part string").withColumn("n_rows", F.lit(0).cast("long"))
        log = counts.unionByName(emptied).groupBy("_part").agg(F.sum("n_rows").alias("n_rows"))
        self._publish(self._entries(log, version))

    def _write(self, tagged: DataFrame, version: int) -> DataFrame:
        """Write tagged rows as the content of a version, which doesn't count yet; (_part, n_rows)."""
        folder = self._path("data", f"_version={version}")
        # what a lost run has left in the folder was never published, and goes
        tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("_part").parquet(folder)
        written = self.spark.read.schema(f"{self.schema.toDDL()}, _part string").parquet(folder)
        return written.groupBy("_part").agg(F.count("*").alias("n_rows"))

    def _entries(self, counts: DataFrame, version: int, merged: tuple | None = None) -> DataFrame:
        """Log entries of parts (_part, n_rows)."""
        how = F.lit(None)
        if merged:
            keys, newest, ties = merged
            how = F.struct(F.array(*map(F.lit, keys)).alias("keys"), F.lit(newest).alias("newest"), F.array(*map(F.lit, ties)).alias("ties"))
        kind = StructType.fromDDL(_LOG)["merged"].dataType
        return counts.select("_part", F.lit(version).cast("long").alias("_version"), "n_rows", how.cast(kind).alias("merged"))

    def _publish(self, log: DataFrame) -> None:
        """One file, which is there or not."""
        log.coalesce(1).write.mode("append").parquet(self._path("log"))

    def merge(self, arrived: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[str] = (), version: int | None = None) -> None:
        """Keep the newest version of every key.

        A key must not change its part. What arrives is written beside the parts that it touches, which
        are neither read nor written again; readers put them together. After ``MOST_MERGED`` contents of a
        part, or if rows were merged otherwise before, the parts concerned are made whole.
        ``ties`` (ascending) decide between equally new versions.
        """
        version = self.last() + 1 if version is None else version
        if version <= self.last():
            return
        how = (tuple(keys), newest, tuple(ties))
        n, known = F.count("*").alias("n"), F.collect_set("merged").alias("known")
        live = self.versions().groupBy("_part").agg(n, known).collect()
        deep = [r["_part"] for r in live if r["n"] >= MOST_MERGED or any(_frozen(m) != how for m in r["known"])]
        if deep:
            self._merge_whole(arrived, how, version, deep)
            return
        delta = self.tagged(arrived)
        counts = self._write(delta if self.few else delta.hint("rebalance", "_part"), version)
        if counts.isEmpty():
            drop_dir(self.spark, self._path("data", f"_version={version}"))
        else:
            self._publish(self._entries(counts, version, how))

    def _merge_whole(self, arrived: DataFrame, how: tuple, version: int, deep: Sequence[str]) -> None:
        """Merge by giving whole content to the parts that ``arrived`` touches, and to ``deep`` ones.

        What arrives is made unique and written aside first: it is as large as the delta, and goes once
        the merge is published.
        """
        keys, newest, ties = how
        aside = scratch_dir(self.spark, "delta")
        self.tagged(latest_per_key(arrived.select(*self.schema.names), keys, newest, ties)).write.option("compression", "zstd").parquet(aside)
        delta = self.spark.read.schema(f"{self.schema.toDDL()}, _part string").parquet(aside)
        touched = [r["_part"] for r in delta.select("_part").distinct().collect()]
        if touched:
            both = self.read([*{*touched, *deep}]).unionByName(delta.drop("_part"))
            self.replace(latest_per_key(both, keys, newest, ties), version)
        drop_dir(self.spark, aside)
