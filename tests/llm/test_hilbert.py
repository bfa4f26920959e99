"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import hilbert


def brute(rows, ask, most=hilbert.NEIGHBOURS):
    ok = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, v in ok:
        if ask(q):
            near = {}
            for i, w in ok:
                if i != q and len(w) == len(v):
                    near[i] = max(near.get(i, -2), round(float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), 12))
            out[q] = sorted((-s, i) for i, s in near.items())[:most]
    return out


def search(spark, rows, ask=2):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    out = {}
    for r in hilbert.nearest(df, F.col("vec_id") % ask == 0).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-round(r.score, 12), r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_keys_walk_through_neighbouring_cells():
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = hilbert.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_odd_vectors_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, float(i % 3), 0.5]) for i in range(30)] + [(i, [0.0, 1.0]) for i in (30, 31)]
    rows += [(40, None), (42, []), (44, [0.0, 0.0, 0.0]), (46, [1.0, None, 1.0]), (48, [nan, 1.0, 1.0])]
    rows += [(50, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (52, [3e38, 3e38, 3e38]), (4, [1.0, 1.0, 0.5]), (54, [7.0])]
    got, want = search(spark, rows), brute([(i, v) for i, v in rows], lambda i: i % 2 == 0)
    want.pop(54)  # alone with its length
    assert {q: w for q, w in got.items() if q != 4} == {q: w for q, w in want.items() if q != 4}
    assert search(spark, []) == {}


def test_blocks_of_a_split_range_meet_every_query(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "BLOCK", 2)
    monkeypatch.setattr(hilbert, "BESIDE", hilbert.RANGES)
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(6).astype(np.float32).tolist()) for i in range(100)]
    assert search(spark, rows) == brute(rows, lambda i: i % 2 == 0)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_recall_of_the_query(spark, sf):
    from llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 50 == 0)
    got = {}
    for r in QUERIES["op1_hilbert_neighbours"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(got[q]) == hilbert.NEIGHBOURS for q in want)
    assert sum(len(got[q] & {i for _, i in w}) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))
