"""N-gram filter: against exact counts in plain Python, and the two ways to the filter against each other."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import ngrams
from llm.words import blocks

WORDS = "the of a cat dog The house tree walks seldom élan 7 - x".split()
SIZES = "doc_id", "n_tokens", "n_known", "train_tokens"


def text(r, n):
    return "".join(r.choice(WORDS[: r.choice((3, 6, 14))]) + r.choice((" ", "\n", "  ", "\t")) for _ in range(n))


def table():
    r = random.Random(1)
    rows = [(i, text(r, r.randrange(60))) for i in range(300)]
    rows += [(5, "the cat the cat")] * 150 + [(None, "a dog"), (None, None), (301, None), (302, ""), (303, " \n")]
    return rows + [(304, text(r, 30_000)), (16, "unseen here " * 400), (306, "unseen" * 9)]


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute_force(rows, model):
    """(base, score, ...) of each row by dictionaries of exact counts, and of the levels that the filter gives."""
    counts = [Counter(), Counter()]
    for doc_id, t in rows:
        if not is_held_out(doc_id):
            words = ["<", *tokens(t)]
            for n in range(2):
                counts[n].update(tuple(words[i : i + n + 1]) for i in range(len(words) - n))
    starts = counts[0].pop(("<",), 0)
    total, kinds = sum(counts[0].values()), len(counts[0])
    counts[0][("<",)] = starts
    parts = [np.frombuffer(r["words"], np.uint64) for r in model.filter.collect()]
    assert len(parts) == 1
    held, level = ngrams.Filter(parts[0], np.array([0, len(parts[0])])), {}
    for _, t in rows:
        g = ngrams.grams(next(blocks(pa.array([t or ""]), lower=True)))
        words = ["<", *tokens(t)]
        for n, keys in enumerate((g.one, g.two[1:])):
            found = held.levels(keys, np.zeros(len(keys), np.int64)).tolist()
            level.update((tuple(words[i : i + n + 1]), q) for i, q in enumerate(found))
    true = {gram: counts[len(gram) - 1][gram].bit_length() for gram in level}
    assert all(level[gram] >= true[gram] for gram in level)  # never too low, seldom too high
    assert sum(level[gram] > true[gram] for gram in level) < 0.1 * len(level)
    near = lambda q: math.sqrt(2 ** (q - 1) * (2**q - 1)) if q else 0
    out = []
    for _, t in rows:
        words = ["<", *tokens(t)]
        base = sum(math.log10((counts[0][(w,)] + 1) / (total + kinds + 1)) for w in words[1:])
        score = 0.0
        for before, w in zip(words, words[1:]):
            context, own = near(level[(before,)]), near(level[(w,)])
            pair = near(level[(before, w)]) if context and own else 0
            p = (own + 1) / (total + kinds + 1)
            score += math.log10((min(pair, context) + ngrams.PRIOR * p) / (context + ngrams.PRIOR))
        out.append((base, score, len(words) - 1, sum(counts[0][(w,)] > 0 for w in words[1:]), total))
    return out


@pytest.mark.parametrize("most, heavy", [(ngrams.MOST_BROADCAST, 20), (0, ngrams.MOST_HEAVY)])
def test_against_brute_force(spark, most, heavy):
    rows = table()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, key int")
    learned = ~ngrams.held_out()
    model = ngrams.train(docs.filter(learned))
    got = ngrams.score(docs, model, learned, most, heavy=heavy).collect()
    want = brute_force(rows, model)
    mine = sorted(((r.doc_id, not r.learned, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=lambda r: (str(r[0]), r[2], r[5]))
    theirs = sorted(((d, is_held_out(d), n, known, total, base, score) for (d, _), (base, score, n, known, total) in zip(rows, want)), key=lambda r: (str(r[0]), r[2], r[5]))
    assert [r[:5] for r in mine] == [r[:5] for r in theirs]
    assert all(a[5] == pytest.approx(b[5], rel=1e-9) for a, b in zip(mine, theirs))
    assert all(a[6] == pytest.approx(b[6], rel=1e-9) for a, b in zip(mine, theirs))
    assert sum(r[6] for r in mine) > sum(r[5] for r in mine)


def test_both_ways_are_the_same(spark, rows):
    r = random.Random(2)
    texts = [(i, " ".join(str(r.randrange(100_000)) for _ in range(3000))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = ngrams.train(docs.filter("doc_id % 8 > 0"))
    assert model.segments > 1
    learned = F.col("doc_id") % 8 > 0
    one, other = (rows(ngrams.score(docs, model, learned, most, 1, 1 << 14)) for most in (ngrams.MOST_BROADCAST, 0))
    assert [r[:5] for r in one] == [r[:5] for r in other]
    assert np.allclose([r[6] for r in one], [r[6] for r in other], rtol=1e-12)


def test_texts_ask_the_segments_by_blocks(spark, rows):
    r = random.Random(4)
    texts = [(i, " ".join(str(r.randrange(20_000)) for _ in range(300))) for i in range(600)]
    texts += [(7, "one of many")] * 300 + [(None, "a b"), (None, None), (601, "")]
    docs, learned = spark.createDataFrame(texts, "doc_id long, text string"), ~ngrams.held_out()
    model = ngrams.train(docs.filter(learned))
    dealt = ngrams._in_blocks(docs.select(F.monotonically_increasing_id().alias("row"), "text"), 1 << 18)
    asks = ngrams._asks(dealt, 40, 8)
    assert 1 < dealt.select("block").distinct().count() < 10
    assert asks.count() == asks.select("block", "group").distinct().count() == 5 * dealt.select("block").distinct().count()
    one, other = (ngrams.score(docs, model, learned, most, asking=1 << 18) for most in (ngrams.MOST_BROADCAST, 0))
    plan = other._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == plan.count("FlatMapCoGroupsInArrow") == 1
    one, other = rows(one), rows(other)
    assert len(one) == len(texts) and [r[:5] for r in one] == [r[:5] for r in other]
    assert np.allclose([r[5:] for r in one], [r[5:] for r in other], rtol=1e-12)


def test_levels_of_a_segment():
    r = np.random.default_rng(3)
    key = r.integers(0, 1 << 63, 400_000).astype(np.uint64)
    levels = np.minimum(r.geometric(0.7, len(key)), 40)
    words = ngrams.fill(key, levels)
    held = ngrams.Filter(words, np.array([0, len(words)]))
    found = held.levels(key, np.zeros(len(key), np.int64))
    assert (found >= levels).all() and (found > levels).mean() < 0.04
    other = r.integers(1 << 63, 1 << 64, 200_000, dtype=np.uint64)
    assert (held.levels(other, np.zeros(len(other), np.int64)) > 0).mean() < 0.04
    assert (ngrams._unpacked(ngrams._packed(key)) == key & ngrams._KEY).all()


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngrams.score(docs, ngrams.train(docs), F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = ngrams.score(one, ngrams.train(docs), F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
