"""Near-duplicate documents: banded MinHash, sequential Bayesian pruning, exact verification.

A document's set is that of its distinct shingles of five lower-cased words. Documents of equal
sets form a class, which one of them stands for. Classes that share a band of their signatures
are candidates. Comparing two signatures 32 hashes at a time, a pair is dropped once the
posterior probability of reaching the threshold, given the matches so far and a uniform prior,
falls below ``MISS``. What survives is verified on the full sets.

A band's bucket is never paired with itself. First each bucket is compared with its hub, the
member that shares most buckets with others, which joins nearly all of a group. Only then are the
members outside a bucket's largest component compared with the rest, block by block inside tasks
that return links and no pairs. So the work on a group of copies is linear unless it holds many
documents that are close to it and yet linked with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from llm.tables import components, runs, shuffle_partitions, store
from llm.words import WORD_POWERS, Block, blocks, mix

SHINGLE = 5
NEED = 75  # percent of the union
HASHES, BANDS, STEP = 128, 32, 32
MISS = 1e-7  # chance of pruning a pair that reaches the threshold
BLOCK = 512  # members, or queries, of a bucket that meet in one task
SETS_AT_ONCE = 64  # full sets that a worker gets in one batch

_ROWS = HASHES // BANDS
_FACTORS = (np.random.default_rng(5).integers(1, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def least_matches(hashes: int, need: float = NEED / 100, miss: float = MISS) -> int:
    """Fewest matches among so many hashes that leave a posterior of at least ``miss``.

    With a uniform prior, P(similarity >= t | m of n match) is the chance of at most m successes
    in n + 1 trials of probability t.
    """
    total = 0.0
    for m in range(hashes + 1):
        total += math.comb(hashes + 1, m) * need**m * (1 - need) ** (hashes + 1 - m)
        if total >= miss:
            return m
    return hashes


_LEAST = {n: least_matches(n) for n in range(STEP, HASHES + 1, STEP)}


def shingle_hashes(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block, repeats included, and the bounds of the texts in them.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    counts = b.counts
    short = (counts > 0) & (counts < SHINGLE)
    number = np.where(short, 1, np.maximum(counts - SHINGLE + 1, 0))
    bounds = np.concatenate([[0], np.cumsum(number)])
    start = np.arange(bounds[-1]) + np.repeat(b.word_at[:-1] - bounds[:-1], number)
    end = start + np.repeat(np.where(short, counts, SHINGLE), number)
    return WORD_POWERS.spans(b.hash, start, end), bounds


def shingle_sets(b: Block) -> list[np.ndarray]:
    hashes, at = shingle_hashes(b)
    return [np.unique(hashes[at[i] : at[i + 1]]) for i in range(b.texts)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES minima per non-empty set."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(0, HASHES, 8):
        out[:, k : k + 8] = np.minimum.reduceat(values[None, :] * _FACTORS[k : k + 8, None], at, axis=1).T
    return out


_SET_SCHEMA = "doc_id long, n_shingles long, digest_a long, digest_b long, signature binary"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for b in blocks(batch.column(1), lower=True):
            sets = shingle_sets(b)
            sizes = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(sizes)
            digests = np.zeros((2, b.texts), np.uint64)
            marks: list[bytes | None] = [None] * b.texts
            if len(some):
                full = [sets[i] for i in some]
                values, at = np.concatenate(full), np.cumsum([0, *sizes[some][:-1]])
                for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
                    digests[k, some] = np.add.reduceat(mix(values ^ np.uint64(salt)), at)
                for i, s in zip(some, signatures(full), strict=True):
                    marks[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(b.first, b.texts),
                    pa.array(sizes),
                    pa.array(digests[0].view(np.int64)),
                    pa.array(digests[1].view(np.int64)),
                    pa.array(marks, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest_a", "digest_b", "signature"],
            )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Signatures of a column without nulls."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        wide = _matrix(batch.column("signature")).reshape(-1, BANDS, _ROWS).astype(np.uint64)
        keys = mix((mix(wide) * powers).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.ravel().view(np.int64)),
                pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)),
                pa.array(np.repeat(np.asarray(batch.column("id")), BANDS)),
            ],
            names=["key", "band", "id"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in blocks(batch.column("text"), lower=True):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(b.first, b.texts),
                    pa.array([s.tobytes() for s in shingle_sets(b)], pa.binary()),
                ],
                names=["id", "items"],
            )


def candidate_pairs(
    query: np.ndarray, member: np.ndarray, comp: np.ndarray, size: np.ndarray, marks: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, member row) of different components that sequential pruning leaves."""
    few, many = np.minimum.outer(size[query], size[member]), np.maximum.outer(size[query], size[member])
    alive = (100 * few >= NEED * many) & (comp[query][:, None] != comp[member][None, :])
    left, right = np.nonzero(alive)
    matches = np.zeros(len(left), np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        if not len(left):
            break
        part = slice(n - STEP, n)
        for at in range(0, len(left), 1 << 16):  # bounds what is compared at once
            few = slice(at, at + (1 << 16))
            matches[few] += (marks[query[left[few]], part] == marks[member[right[few]], part]).sum(1)
        keep = matches >= _LEAST[n]
        left, right, matches = left[keep], right[keep], matches[keep]
    return query[left], member[right]


def _pairs_of(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a block, and its surviving pairs as row numbers.

    Of pairs that share several bands only the first band's bucket takes care, and pairs with
    the bucket's hub have been compared before. Both hold only where a band is given.
    """
    ids, role = np.asarray(t["id"]), np.asarray(t["role"])
    marks = _matrix(t["signature"])
    a, b = candidate_pairs(
        np.flatnonzero(role == 0), np.flatnonzero(role > 0), np.asarray(t["comp"]), np.asarray(t["n"]), marks
    )
    keep = ~((role[b] == 2) & (ids[b] < ids[a]))  # both are queries: once is enough
    band = int(t["band"][0].as_py())
    if band >= 0:
        hub = t["hub"][0].as_py()
        keep &= (ids[a] != hub) & (ids[b] != hub)
        a, b = a[keep], b[keep]
        keep = np.zeros(len(a), bool)
        for at in range(0, len(a), 1 << 14):  # bounds what is compared at once
            few = slice(at, at + (1 << 14))
            keep[few] = (marks[a[few]] == marks[b[few]]).reshape(-1, BANDS, _ROWS).all(2).argmax(1) == band
    return ids, a[keep], b[keep]


def _surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block that take part in a surviving pair."""
    for t in runs(batches, "key", "block"):
        _, a, b = _pairs_of(t)
        if len(a):
            yield from t.take(pa.array(np.unique(np.concatenate([a, b])))).combine_chunks().to_batches()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a block that hold on the full sets, without those that close a cycle."""
    for t in runs(batches, "key", "block"):
        ids, left, right = _pairs_of(t)
        items = t["items"]  # read where they lie, without a copy of the block
        comp = np.asarray(t["comp"])
        parent = {c: c for c in comp.tolist()}

        def top(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        links = []
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            x, y = top(int(comp[i])), top(int(comp[j]))
            if x == y:
                continue
            one, other = (np.frombuffer(items[k].as_buffer(), np.uint64) for k in (i, j))
            both = len(np.intersect1d(one, other, assume_unique=True))
            if 100 * both >= NEED * (len(one) + len(other) - both):
                parent[x] = y
                links.append((ids[i], ids[j]))
        if links:
            one, two = np.array(links, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], names=["a", "b"])


_BLOCK_ROW = "key long, block int, band int, hub long, id long, role int, comp long"


def _compare(rows: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links inside blocks of rows; role 0 is a query, 1 a member, 2 a member that is also a query."""
    parts = shuffle_partitions(rows.sparkSession)
    order = ["key", "block", "role", "id"]
    marked = rows.join(classes.select("id", "n", "signature"), "id").select(
        *(f.split()[0] for f in _BLOCK_ROW.split(", ")), "n", "signature"
    )
    alive = (
        marked.repartition(parts, "key", "block")
        .sortWithinPartitions(*order)
        .mapInArrow(_surviving, f"{_BLOCK_ROW}, n long, signature binary")
    )
    return store(
        store(alive, "alive")
        .join(sets, "id")
        .repartition(parts, "key", "block")
        .sortWithinPartitions(*order)
        .mapInArrow(_verified, "a long, b long"),
        "links",
        SETS_AT_ONCE,
    )


def _spread(value: str, into: Column) -> Column:
    return F.pmod(F.xxhash64(value), into).cast("int")


def _stars(members: DataFrame) -> DataFrame:
    """Every member beside its buckets' hubs, once per pair, as blocks of a hub and some members."""
    hubs = members.groupBy("key").agg(F.max(F.struct("weight", -F.col("id"))).alias("h"))
    pairs = (
        members.select("key", "id")
        .join(hubs.select("key", (-F.col("h.col2")).alias("hub")), "key")
        .filter("id != hub")
        .select("hub", "id")
        .distinct()
    )
    pairs = store(pairs, "pairs")
    number = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    row = [F.lit(-1).alias("band"), F.lit(None).cast("long").alias("hub")]
    near = pairs.join(number, "hub").select(
        F.col("hub").alias("key"), _spread("id", F.col("blocks")).alias("block"), *row, "id", F.lit(1).alias("role")
    )
    far = number.select(
        F.col("hub").alias("key"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *row,
        F.col("hub").alias("id"), F.lit(0).alias("role"),
    )
    return near.union(far).withColumn("comp", F.col("id"))


def _rest(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of buckets that hold several components: those outside the largest one are queries."""
    placed = store(
        members.join(comps, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component"), "placed"
    )
    shares = placed.groupBy("key", "band", "comp").agg(
        F.count("*").alias("n"), F.max(F.struct("weight", -F.col("id"))).alias("h")
    )
    stats = (
        shares.groupBy("key")
        .agg(
            F.sum("n").alias("n"),
            F.max(F.struct("n", "comp")).alias("m"),
            (-F.max("h")["col2"]).alias("hub"),
            F.count("*").alias("comps"),
        )
        .filter("comps > 1 and n > 2")  # of two members one is the hub
        .select(
            "key",
            "hub",
            F.col("m.comp").alias("most"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("mb"),
            F.ceil((F.col("n") - F.col("m.n")) / BLOCK).cast("int").alias("qb"),
        )
    )
    here = placed.join(stats, "key")
    outside = F.col("comp") != F.col("most")
    names = [f.split()[0] for f in _BLOCK_ROW.split(", ")]
    q, m = _spread("id", F.col("qb")), _spread("id", F.col("mb"))
    as_member = here.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"), F.when(outside, 2).otherwise(1).alias("role")
    ).withColumn("block", F.col("q") * F.col("mb") + m)
    as_query = here.filter(outside).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("k"), F.lit(0).alias("role")
    ).withColumn("block", q * F.col("mb") + F.col("k"))
    return as_member.select(*names).union(as_query.select(*names))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text, ...).

    A null or empty text, or one without words, has an empty set and is linked with nothing.
    Rows that repeat a doc_id are one document with several texts: linked. A row without a doc_id
    takes no part: its component is null and it is kept. Other columns are not read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = store(base.mapInArrow(_describe, _SET_SCHEMA), "sets")
    known = described.filter("doc_id is not null and n_shingles > 0")
    same = ["n_shingles", "digest_a", "digest_b"]
    first = known.groupBy(*same).agg(F.min("doc_id").alias("id"))
    member_of = store(known.join(first, same).select("doc_id", "id", "n_shingles", *same[1:]), "classes")
    classes = (
        described.join(
            member_of.filter("doc_id = id").select("doc_id", *same).distinct(), ["doc_id", *same], "left_semi"
        )
        .dropDuplicates(["doc_id", *same])
        .select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "signature")
    )
    classes = store(classes, "signatures")

    bands = classes.select("id", "signature").mapInArrow(_band_keys, "key long, band int, id long")
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = store(bands.join(shared, "key"), "members")
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))
    members = store(members.select("key", "band", "id").join(weights, "id"), "members")
    wanted = weights.select("id")
    texts = base.join(wanted, base["doc_id"] == wanted["id"]).select("id", "text")
    sets = store(texts.mapInArrow(_sets, "id long, items binary"), "items")

    links = _compare(_stars(members), classes, sets)
    repeated = (
        member_of.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).filter("a != b").distinct()
        .join(described.groupBy(F.col("doc_id").alias("a")).count().filter("count > 1").select("a"), "a", "left_semi")
    )
    comps = store(components(links.union(repeated.select("a", "b"))), "components")
    links = links.union(_compare(_rest(members, comps), classes, sets)).union(repeated.select("a", "b"))
    comps = store(components(links), "components")

    labels = member_of.groupBy("doc_id").agg(F.min("id").alias("id"))
    labels = labels.join(comps, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component_id"))
    return (
        described.select("doc_id", "n_shingles")
        .join(labels, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )
