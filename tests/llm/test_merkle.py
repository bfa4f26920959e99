"""Merkle manifest: roots and proofs against plain hashing."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    steps = []
    for nodes in tree[:-1]:
        other = i ^ 1
        steps.append((nodes[other] if other < i else "", nodes[other] if i < other < len(nodes) else ""))
        i >>= 1
    return steps


def expected(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {k: sorted(by_lang[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for k in langs}
    trees = {k: levels([leaf_of(r) for r in ordered[k]]) for k in langs}
    top = levels([trees[k][-1][0] for k in langs])
    root, out = top[-1][0], []
    for j, k in enumerate(langs):
        for i, r in enumerate(ordered[k]):
            steps, own = path(trees[k], i) + path(top, j), trees[k][0][i]
            node = own
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                node = leaf_of((*r[:3], r[3] + 1, r[4]))
            for left, right in steps:
                node = digest(left + node + right)
            out.append((r[0], own, trees[k][-1][0], root, digest("".join(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=repr)


COLUMNS = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, pos int, item int"


def manifest(spark, table):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in table], SCHEMA)
    return merkle.checked(merkle.manifest(docs, merkle.planted_tampering()))


@pytest.mark.parametrize("digits", [1, 2, 10])
def test_against_plain_hashing(spark, rows, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    table = [(i * 3 % 41, f"s{i % 3}", lang, 5 + i, "é" * (i % 7)) for lang, n in (("de", 37), ("en", 8), ("z", 1), ("Z", 2), (None, 5)) for i in range(n)]
    table += [(None, None, "en", None, None), (7, "s", "en", None, ""), (None, "a", None, 1, "x" * 100_000)]
    table += [(100, "same", "en", 4, "copy")] * 30  # a third of all rows
    assert rows(manifest(spark, table), *COLUMNS) == expected(table)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, rows, n):
    table = [(i, "s", "en", 3, "abc") for i in range(n)]
    assert rows(manifest(spark, table), *COLUMNS) == expected(table) if n else not manifest(spark, table).collect()


def test_no_join_brings_the_proofs(spark):
    item = F.struct(F.col("id").alias("doc_id"), F.lit("").alias("h"))
    ranks = spark.range(10).select(F.lit("k").alias("key"), "id", F.lit(10).cast("long").alias("n"), F.col("id").alias("pos"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    nodes = ranks.select("key", "n", "pos", F.struct("h", item.alias("kids")).alias("node"))
    rounds = [merkle._blocks(nodes, 0)]
    above = rounds[0].select("key", F.array().cast(merkle._STEP).alias("path"), F.struct(F.lit("").alias("subroot"), F.col("node.h").alias("root")).alias("top"))
    plan = merkle._opened(rounds, above)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
