"""Approximate nearest neighbours by shifted Hilbert curves over projected vectors.

Every ordering projects the unit vectors to a few random directions, shifts and scales the
coordinates, and takes the place of the cell on a Hilbert curve as key. Rows are dealt out by key
ranges of about equal size; a query looks at its own range and at the neighbouring ones, and
scores all of their rows exactly, in double precision. The best of each ordering are merged and
ranked again. Equal vectors are searched once: of them only the few smallest ids can appear.

Ranges hold a share of the rows, so recall doesn't depend on the size of the table. Vectors whose
nearest neighbours are hardly nearer than the rest, as in random data, need many orderings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from llm.tables import runs, shuffle_partitions, store

NEIGHBOURS = 5
CURVES = 16
AXES = 8
BITS = 4  # per axis
SHIFT = 0.25  # largest shift of an axis, as a share of its extent
RANGES = 32
BESIDE = 1  # ranges on either side that a query looks at too
LEAST = 16  # vectors that a range should hold, in tables with too few for RANGES
SAMPLE = 4096  # vectors that axes and ranges are fitted to, smallest hash first
BLOCK = 4096  # vectors, or queries, of a range that meet in one task


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of cells (rows of ``axes`` integers below 2**bits) on a Hilbert curve through all.

    Each axis is turned from its binary to its Gray-coded form, from the highest bit down, with
    the reflections that the bits above ask for; the bits of all axes then interleave.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curve:
    """One ordering of vectors of one length, fitted to a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, seed: int):
        random = np.random.default_rng([seed, sample.shape[1]])
        axes = min(AXES, sample.shape[1])
        self.axes = np.linalg.qr(random.standard_normal((sample.shape[1], axes)))[0]
        self.shift = random.uniform(0, SHIFT, axes)
        self.steps = np.sort(sample @ self.axes, axis=0)
        keys = np.sort(self.keys(sample, np.arange(len(sample))))
        ranges = min(RANGES, 1 + len(sample) // LEAST)
        self.cuts = keys[(np.arange(1, ranges) * len(keys)) // ranges]

    def keys(self, units: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Keys on the curve; equal places are told apart by ``ties``, so that hot ones can be dealt out."""
        at = units @ self.axes
        share = np.stack([np.searchsorted(s, a) for s, a in zip(self.steps.T, at.T, strict=True)], 1) / len(self.steps)
        cells = np.minimum((share + self.shift) / (1 + SHIFT) * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
        return (hilbert_keys(cells, BITS) << 30) | (ties & ((1 << 30) - 1))

    def ranges(self, units: np.ndarray, ties: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, self.keys(units, ties), "right")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) of a list column without nulls, one pair per length."""
    sizes = np.asarray(column.value_lengths())
    flat, at = np.asarray(column.flatten()).astype(float), np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        out.append((rows, flat[at[rows][:, None] + np.arange(n)]))
    return out


_ROW = "curve int, dim int, reach int, block long, role int, code_a long, code_b long, ids array<long>, embedding array<double>"


def _deal(curves: dict[int, list[Curve]], splits: int, query_splits: int):
    """Rows (role, code_a, code_b, ids, embedding) into blocks: role 0 asks, role 1 is found."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            role, code = np.asarray(batch.column("role")), np.asarray(batch.column("code_a"))
            for rows, vectors in _vectors(batch.column("embedding")):
                units, dim = unit(vectors), vectors.shape[1]
                # a length that the sample lacks has a single range
                for k, curve in enumerate(curves.get(dim, [None])):
                    home = curve.ranges(units, code[rows]) if curve else np.zeros(len(rows), np.int64)
                    for step in range(-BESIDE, BESIDE + 1):
                        for copy in range(max(splits, query_splits)):
                            asks = (role[rows] == 0) & (copy < splits)
                            found = (role[rows] == 1) & (copy < query_splits) & (step == 0)
                            reach = home + step
                            use = (asks | found) & (reach >= 0) & (reach < RANGES)
                            if not use.any():
                                continue
                            own = code[rows][use]
                            block = np.where(
                                asks[use], (own % query_splits) * splits + copy, copy * splits + own % splits
                            )
                            n = int(use.sum())
                            taken = batch.take(pa.array(rows[use]))
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.full(n, k, np.int32)),
                                    pa.array(np.full(n, dim, np.int32)),
                                    pa.array(reach[use].astype(np.int32)),
                                    pa.array(block),
                                    *(taken.column(c) for c in ("role", "code_a", "code_b", "ids", "embedding")),
                                ],
                                names=[f.split()[0] for f in _ROW.split(", ")],
                            )

    return deal


def _search(most: int):
    """The nearest of a block for each vector that asks, with one to spare for the query itself."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "curve", "dim", "reach", "block"):
            t = t.combine_chunks()
            role = np.asarray(t["role"])
            asks, there = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
            if not len(asks) or not len(there):
                continue
            ((_, vectors),) = _vectors(t["embedding"].chunk(0))
            units = unit(vectors)
            ids = t["ids"].to_pylist()
            code = np.asarray(t["code_a"]), np.asarray(t["code_b"])
            out: list[tuple[int, int, int, float]] = []
            keep = min(most + 1, len(there))
            for i, row in zip(asks, units[asks] @ units[there].T, strict=True):
                near = there[row >= np.partition(row, -keep)[-keep] - 1e-9]
                exact = (units[near] * units[i]).sum(1)
                best = sorted((-s, v) for s, j in zip(exact.tolist(), near.tolist(), strict=True) for v in ids[j])
                out += [(code[0][i], code[1][i], v, -s) for s, v in best[: most + 1]]
            yield pa.RecordBatch.from_pydict(
                dict(zip(("code_a", "code_b", "vec_id", "score"), map(list, zip(*out, strict=True)), strict=True)),
                schema=pa.schema([("code_a", pa.int64()), ("code_b", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]),
            )

    return search


def sound(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, asks: Column, most: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row of vectors for which ``asks`` holds.

    ``vectors`` has vec_id and embedding; other columns are not read. Rows without an id, and
    vectors that are null, empty, zero or hold null or non-finite components, take no part. Vectors
    of different lengths are not compared. Rows of the query's own id are not found. Nearest is
    the largest cosine; of equal ones the smaller vec_id comes first.
    """
    spark = vectors.sparkSession
    embedding = F.col("embedding").cast("array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"), F.coalesce(asks, F.lit(False)).alias("asks")
    ).filter(F.col("vec_id").isNotNull() & sound(F.col("embedding")))
    code = [F.xxhash64("embedding").alias("code_a"), F.xxhash64(F.lit(1), "embedding").alias("code_b")]
    rows = store(rows.select("vec_id", "embedding", "asks", *code), "vectors")

    # One row per distinct vector, with the ids that can be among a query's nearest.
    by_id = Window.partitionBy("code_a", "code_b").orderBy("vec_id")
    kinds = (
        rows.withColumn("place", F.dense_rank().over(by_id))
        .filter(F.col("place") <= most + 1)
        .groupBy("code_a", "code_b")
        .agg(F.collect_set("vec_id").alias("ids"), F.first("embedding").alias("embedding"))
    )
    kinds = store(kinds, "kinds")
    queries = rows.filter("asks").select("vec_id", "code_a", "code_b")
    wanted = kinds.join(queries.select("code_a", "code_b").distinct(), ["code_a", "code_b"], "left_semi")

    sample = kinds.orderBy("code_a", "code_b").limit(SAMPLE).select("embedding").collect()
    curves: dict[int, list[Curve]] = {}
    for n in {len(r[0]) for r in sample}:
        units = unit(np.array([r[0] for r in sample if len(r[0]) == n]))
        curves[n] = [Curve(units, k) for k in range(CURVES)]
    splits = max(1, -(-kinds.count() // (RANGES * BLOCK)))
    query_splits = max(1, -(-wanted.count() * (2 * BESIDE + 1) // (RANGES * BLOCK)))

    group = ["curve", "dim", "reach", "block"]
    columns = ["code_a", "code_b", "ids", "embedding"]
    found = (
        kinds.select(F.lit(1).alias("role"), *columns)
        .union(wanted.select(F.lit(0).alias("role"), *columns))
        .mapInArrow(_deal(curves, splits, query_splits), _ROW)
        .repartition(max(shuffle_partitions(spark), splits * query_splits), *group)
        .sortWithinPartitions(*group)
        .mapInArrow(_search(most), "code_a long, code_b long, vec_id long, score double")
        .groupBy("code_a", "code_b", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    best = Window.partitionBy("code_a", "code_b").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most + 1)
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.withColumnRenamed("vec_id", "query_id")
        .distinct()
        .join(found, ["code_a", "code_b"])
        .filter("vec_id != query_id")
        .withColumn("rank", F.row_number().over(own).cast("int"))
        .filter(F.col("rank") <= most)
        .select("query_id", "rank", "vec_id", "score")
    )
