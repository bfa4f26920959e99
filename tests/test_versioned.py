"""Tables of replaceable parts: all or nothing, and no more read than touched."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.operators.dedupe import latest_per_key
from tallyhouse.sources import versioned

SCHEMA = "id string, day date, scraped_on int, v int"
D1, D2, D3 = (dt.date(2024, 1, n) for n in (1, 2, 3))


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return versioned.PartTable(spark, str(tmp_path / "t"), schema, versioned.by_day("day"))


@pytest.fixture
def put(spark):
    return lambda *data: spark.createDataFrame(list(data), SCHEMA)


def test_parts_are_replaced_and_others_stay(table, put, rows):
    assert rows(table.read()) == []
    table.replace(put(("a", D1, 1, 1), ("b", D2, 1, 2), ("n", None, 1, 3)), 1)
    table.replace(put(("c", D1, 1, 4)), 2)
    assert rows(table.read(), "id", "v") == [("b", 2), ("c", 4), ("n", 3)]
    table.replace(put(("d", D1, 1, 9)), 2)  # published before
    assert rows(table.read(), "id", "v") == [("b", 2), ("c", 4), ("n", 3)]
    table.replace(put(), 3, parts=["2024-01-02"])
    assert rows(table.read(), "id", "v") == [("c", 4), ("n", 3)]


def test_a_run_lost_between_two_days_changes_nothing(table, put, rows, monkeypatch):
    table.replace(put(("a", D1, 1, 1), ("b", D2, 1, 2)), 1)
    old, new = [("a", 1), ("b", 2)], [("a", 10), ("b", 20)]
    fresh = put(("a", D1, 2, 10), ("b", D2, 2, 20))
    lost = fresh.withColumn("v", F.when(F.col("day") == D2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.replace(lost, 2)
    assert rows(table.read(), "id", "v") == old

    def stop(self, log):
        raise RuntimeError("lost before the log")

    with monkeypatch.context() as m:
        m.setattr(versioned.PartTable, "_publish", stop)
        with pytest.raises(RuntimeError):
            table.replace(fresh, 2)
    assert rows(table.read(), "id", "v") == old
    table.replace(fresh, 2)
    assert rows(table.read(), "id", "v") == new


def test_a_reader_that_has_begun_keeps_its_version(table, put, rows):
    table.replace(put(("a", D1, 1, 1)), 1)
    begun = table.read()
    table.replace(put(("a", D1, 2, 2)), 2)
    assert rows(begun, "v") == [(1,)] and rows(table.read(), "v") == [(2,)]


def test_deltas_equal_the_full_load(spark, rows, tmp_path):
    scrapes = spark.range(600).select(
        F.concat(F.lit("k"), F.col("id") % 97).alias("id"),
        F.date_add(F.lit(D1), (F.col("id") % 97 % 30).cast("int")).alias("day"),
        (F.col("id") * 37 % 600).cast("int").alias("scraped_on"),
        F.col("id").cast("int").alias("v"),
    )
    want = rows(latest_per_key(scrapes, ["id"]))
    for part in (versioned.by_day("day"), versioned.by_bucket(["id"], 8)):
        table = versioned.PartTable(spark, str(tmp_path / str(part).replace("/", "_")[-20:].strip("'>")), scrapes.schema, part)
        for n in range(3):
            table.merge(scrapes.filter(F.col("v") % 3 == n), ["id"], "scraped_on", ["v"])
        assert rows(table.read()) == want


def test_a_merge_reads_and_writes_what_it_touches(table, put, spark):
    days = [dt.date(2024, 1, n) for n in range(1, 31)]
    table.merge(put(*((f"k{i}", d, 1, i) for i, d in enumerate(days))), ["id"], "scraped_on")
    size = lambda df: sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in df.inputFiles())
    assert size(table.read(["2024-01-03"])) * 20 < size(table.read())
    table.merge(put(("k2", D3, 2, 99), ("new", D3, 1, 1)), ["id"], "scraped_on")
    changed = table.versions().filter("_version = 2").collect()
    assert [(r["_part"], r["n_rows"]) for r in changed] == [("2024-01-03", 2)]
    assert table.read().count() == 31


def test_a_hot_day_is_written_by_several_tasks(spark, table):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string"), F.lit(D1).alias("day"), F.lit(1).alias("scraped_on"), (F.col("id") % 7919).cast("int").alias("v")
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "100000")
    try:
        table.replace(rows, 1)
    finally:
        spark.conf.set(name, before)
    assert len(table.read().inputFiles()) > 3
    assert table.read().count() == 200_000


def test_null_and_empty(spark, table, put, rows):
    table.merge(put(), ["id"], "scraped_on")
    assert rows(table.read()) == [] and isinstance(table.read().schema, StructType)
    table.merge(put((None, None, None, 1), (None, None, 2, 2)), ["id"], "scraped_on")
    assert rows(table.read(), "v") == [(2,)]


def test_a_merge_leaves_nothing_aside(table, put, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(versioned, "scratch_dir", lambda spark, label: str(tmp_path / label))
    table.merge(put(("a", D1, 1, 1), ("a", D1, 2, 2)), ["id"], "scraped_on")
    assert not (tmp_path / "delta").exists()
    table.merge(put(), ["id"], "scraped_on")
    assert not (tmp_path / "delta").exists() and rows(table.read(), "v") == [(2,)]


def test_merged_rows_stand_beside_what_was_there(spark, table, put, rows, monkeypatch):
    monkeypatch.setattr(versioned, "MOST_MERGED", 3)
    contents = lambda: sorted((r["_part"], r["_version"], r["n_rows"]) for r in table.versions().collect())
    table.replace(put(("a", D1, 1, 1), ("b", D1, 1, 2), ("c", D2, 1, 3)), 1)
    old = set(table.read().inputFiles())
    table.merge(put(("a", D1, 2, 10), ("a", D1, 3, 11), ("d", D1, 1, 4)), ["id"], "scraped_on")
    assert contents() == [("2024-01-01", 1, 2), ("2024-01-01", 2, 3), ("2024-01-02", 1, 1)]
    assert old < set(table.read().inputFiles())  # nothing is written again
    table.merge(put(("a", D1, 2, 99), ("b", D1, 0, 98)), ["id"], "scraped_on")
    want = [("a", 11), ("b", 2), ("c", 3), ("d", 4)]
    assert rows(table.read(), "id", "v") == want and rows(table.read(["2024-01-01"]), "id") == [("a",), ("b",), ("d",)]
    table.merge(put(("c", D2, 2, 30)), ["id"], "scraped_on")  # the day of three contents is made whole
    assert rows(table.read(), "id", "v") == [("a", 11), ("b", 2), ("c", 30), ("d", 4)]
    assert contents() == [("2024-01-01", 4, 3), ("2024-01-02", 4, 1)]
    table.merge(put(("a", D1, 9, 12)), ["id"], "scraped_on")
    table.merge(put(("a", D1, 1, 13)), ["id"], "v")  # made unique otherwise
    assert rows(table.read(), "id", "v") == [("a", 13), ("b", 2), ("c", 30), ("d", 4)]


@pytest.mark.parametrize("few", [False, True])
def test_a_merge_moves_rows_once_at_most(spark, tmp_path, few):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = versioned.PartTable(spark, str(tmp_path / "t"), schema, versioned.by_bucket(["id"], 4), few)
    data = spark.range(1000).select(F.col("id").cast("string"), F.lit(D1).alias("day"), F.lit(1).alias("scraped_on"), F.col("id").cast("int").alias("v"))
    plans = []
    write = versioned.PartTable._write

    def spied(self, tagged, version):
        plans.append(tagged._jdf.queryExecution().executedPlan().toString())
        return write(self, tagged, version)

    versioned.PartTable._write = spied
    try:
        for n in (0, 1):
            table.merge(data.filter(F.col("v") % 2 == n), ["id"], "scraped_on")
    finally:
        versioned.PartTable._write = write
    assert [p.count("Exchange") for p in plans] == [0 if few else 1] * 2
    assert table.read().count() == 1000
    empty = versioned.PartTable(spark, str(tmp_path / "none"), schema, versioned.by_bucket(["id"], 4)).read()
    assert empty.schema.names == schema.names and empty._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1000
