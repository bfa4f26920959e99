"""Incremental pickup and late data as streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.dedupe import latest_per_key
from tallyhouse.sources import versioned
from tallyhouse.streaming import snapshots

SCHEMA = "id string, day timestamp_ntz, scraped_on int, v int"


def put(spark, path, name, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def test_each_file_is_picked_up_once_and_newest_wins(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    day = dt.datetime(2024, 1, 1)

    def run():
        stream = snapshots.file_stream(spark, f"{source}/*", SCHEMA, max_files=1)
        snapshots.land(stream.withColumn("date", F.to_date("day")), out, state, ["date"])

    put(spark, source, "first", ("a", day, 1, 10), ("b", day, 1, 20))
    run()
    put(spark, source, "second", ("a", day, 2, 11))
    put(spark, source, "third", ("b", day, 0, 99))
    run()
    run()  # nothing new
    landed = spark.read.parquet(out)
    assert landed.count() == 4
    assert rows(latest_per_key(landed, ["id"]), "id", "v") == [("a", 11), ("b", 20)]


def test_repeats_within_the_window_are_dropped(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = snapshots.file_stream(spark, f"{source}/*", SCHEMA)
        snapshots.land(snapshots.without_repeats(stream, "day", ["id"]), out, state)

    at = lambda d: dt.datetime(2024, 1, d)
    put(spark, source, "first", ("a", at(10), 1, 1), ("a", at(10), 1, 1), ("b", at(8), 1, 2))
    run()
    put(spark, source, "second", ("a", at(10), 1, 1), ("late", at(9), 1, 3), ("c", at(11), 1, 4))
    run()
    assert rows(spark.read.parquet(out), "id", "v") == [("a", 1), ("b", 2), ("c", 4), ("late", 3)]


def test_newest_wins_over_late_batches(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id string, day date, scraped_on int, v int"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)

    def arrive(name, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.parquet(f"{source}/{name}")
        stream = snapshots.file_stream(spark, f"{source}/*", schema, max_files=1)
        snapshots.land_newest(stream, out, state, ["id"], "day", "scraped_on")
        return rows(spark.read.parquet(out), "id", "day", "v")

    assert arrive("first", ("a", d1, 2, 1), ("b", d2, 2, 2)) == [("a", d1, 1), ("b", d2, 2)]
    assert arrive("late", ("a", d1, 1, 9), ("c", d1, 1, 3)) == [("a", d1, 1), ("b", d2, 2), ("c", d1, 3)]
    assert arrive("newer", ("a", d1, 3, 4)) == [("a", d1, 4), ("b", d2, 2), ("c", d1, 3)]
    assert arrive("again", ("a", d1, 3, 4)) == [("a", d1, 4), ("b", d2, 2), ("c", d1, 3)]  # a batch run twice


def test_streams_read_tables_of_one_file_or_many(spark, tmp_path):
    from workload.queries import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_landing", "stream_exact_repeats"):
        assert QUERIES[name](spark, str(tmp_path)).count() == events.count()


def test_batches_are_published_whole(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], "id string, day date, scraped_on int, v int").schema
    table = versioned.PartTable(spark, out, schema, versioned.by_day("day"))
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)

    def arrive(name, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.parquet(f"{source}/{name}")
        snapshots.merge_newest(snapshots.file_stream(spark, f"{source}/*", schema, max_files=1), table, state, ["id"], "scraped_on")
        return rows(table.read(), "id", "day", "v")

    assert arrive("first", ("a", d1, 2, 1), ("b", d2, 2, 2)) == [("a", d1, 1), ("b", d2, 2)]
    assert arrive("late", ("a", d1, 1, 9), ("c", d1, 1, 3)) == [("a", d1, 1), ("b", d2, 2), ("c", d1, 3)]
    assert arrive("again", ("a", d1, 2, 1)) == [("a", d1, 1), ("b", d2, 2), ("c", d1, 3)]
    assert table.last() == 3


def test_late_rows_are_landed_apart(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    at = lambda d: dt.datetime(2024, 1, d)
    typed = spark.createDataFrame([], SCHEMA).schema

    def arrive(name, *data):
        put(spark, source, name, *data)
        snapshots.land_with_late(snapshots.file_stream(spark, f"{source}/*", SCHEMA), out, state, ["id"], "day")

    def told():
        return rows(snapshots.landed(spark, out, typed), "id", "v"), rows(snapshots.late(spark, out, typed), "id", "v", "batch")

    arrive("1", ("a", at(10), 1, 1), ("a", at(9), 1, 2), ("old", at(1), 1, 3), (None, at(10), 1, 4), (None, at(10), 1, 5))
    assert told() == ([("a", 2), ("old", 3), (None, 4)], [])  # nothing is late before there is a newest row
    arrive("2", ("a", at(10), 1, 6), ("b", at(7), 1, 7), ("c", at(6), 1, 8), ("c", at(6), 1, 8), ("d", None, 1, 9), ("e", at(20), 1, 10))
    assert told()[0] == [("a", 2), ("b", 7), ("e", 10), ("old", 3), (None, 4)]
    assert told()[1] == [("c", 8, 1), ("c", 8, 1), ("d", 9, 1)]
    arrive("3", ("b", at(17), 1, 11), ("f", at(16), 1, 12))  # b has left the window
    assert told()[0] == [("a", 2), ("b", 11), ("b", 7), ("e", 10), ("old", 3), (None, 4)]
    assert told()[1] == [("c", 8, 1), ("c", 8, 1), ("d", 9, 1), ("f", 12, 2)]
    kept = rows(spark.read.parquet(f"{out}/state/2"), "id")
    assert kept == [("b",), ("e",)]  # the window, not the stream
    before = told()
    snapshots.land_with_late(snapshots.file_stream(spark, f"{source}/*", SCHEMA), out, state, ["id"], "day")
    assert told() == before


def test_a_batch_that_runs_again_overwrites_its_rows(spark, rows, tmp_path, monkeypatch):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    at = lambda d: dt.datetime(2024, 1, d)
    typed = spark.createDataFrame([], SCHEMA).schema
    run = lambda: snapshots.land_with_late(snapshots.file_stream(spark, f"{source}/*", SCHEMA), out, state, ["id"], "day")
    put(spark, source, "1", ("a", at(10), 1, 1))
    run()
    put(spark, source, "2", ("b", at(11), 1, 2), ("c", at(1), 1, 3))

    def stop(*_):
        raise RuntimeError("lost at the end of the batch")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "_drop", stop)
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert rows(snapshots.landed(spark, out, typed), "id") == [("a",), ("b",)]
    assert rows(snapshots.late(spark, out, typed), "id", "batch") == [("c", 1)]
