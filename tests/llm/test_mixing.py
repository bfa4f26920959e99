"""Mixing: targets, copies and odd rows; the query against its SQL."""

import pytest

import oracle_check
from llm import mixing


def water(sizes, weights, share=mixing.SHARE, most=mixing.MOST):
    """Targets by sharing the excess again and again."""
    target = dict.fromkeys(sizes, 0.0)
    left, open_ = share * sum(sizes.values()), set(sizes)
    while open_ and left > 1e-9:
        per = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if target[s] + per * weights[s] >= most * sizes[s]}
        for s in full or open_:
            add = most * sizes[s] - target[s] if full else per * weights[s]
            target[s] += add
            left -= add
        if not full:
            break
        open_ -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 2000, "c": 5, "d": 1, "é": 700, None: 90},
        {"a": 0, "b": 0},
        {"B": 1000, "a": 1},
        {"x": 7},
    ],
)
def test_targets_share_the_excess(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    assert got == pytest.approx(water(sizes, weights))


def test_copies_follow_the_rate(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2], "x") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    mixed = mixing.mix(df).cache()
    for r in mixed.groupBy("row.source").agg({"target": "max", "*": "count"}).collect():
        taken = mixed.filter(mixed["row.source"] == r.source).selectExpr("sum(copies * size)").first()[0]
        assert taken == pytest.approx(r["max(target)"], rel=0.05)
    assert mixed.selectExpr("max(copies)").first()[0] <= mixing.MOST
    again = mixing.mix(df.repartition(7))
    assert sorted(mixed.select("row.doc_id", "copies").collect()) == sorted(again.select("row.doc_id", "copies").collect())
    whole = mixing.repeated(mixed)
    assert whole.columns == df.columns and whole.count() == mixed.selectExpr("sum(copies)").first()[0]


def test_nulls_and_empty_tables(spark):
    rows = [(1, None, None), (2, "", "a"), (None, "x y", None), (None, None, "a"), (3, " ", "b"), (3, " ", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert sorted(r.size for r in got) == [0, 0, 0, 0, 0, 2] and {r.target for r in got} == {0.0, 3.0}
    assert mixing.mix(df.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op3_mixing", "op8_chat_format"])
def test_queries_match_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    ok, text = oracle_check.compare(spark, oracle_check.connect(sf), name, sf)
    assert ok, text
