"""Trained operators: held-out accuracy, confirmation, and odd rows."""

import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import licences, linear, quality, toxicity
from llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, p_toxic int, score string"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_logistic_regression_finds_the_weights():
    r = np.random.default_rng(1)
    x = np.hstack([np.ones((5000, 1)), r.standard_normal((5000, 2))])
    true = np.array([0.5, 2.0, -1.0])
    y = (r.random(5000) < linear.sigmoid(x @ true)).astype(float)
    assert linear.fit_logistic(x, y, ridge=0.1, free=1) == pytest.approx(true, abs=0.2)
    assert np.isfinite(linear.fit_logistic(x, (x[:, 1] > 0).astype(float))).all()  # separable


def test_toxic_documents_left_out_of_training(spark, tables):
    docs, labels = tables
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    chain = toxicity.train(docs, labels.filter(~apart))
    got = toxicity.scored(docs, chain).select("row.doc_id", F.col("toxic").alias("found"), "p_insult").join(labels.filter(apart), "doc_id")
    rows = got.collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.found for r in toxic) >= 0.8 * len(toxic)  # a tenth has no marked word at all
    assert sum(r.found for r in rows if r.toxic == 0) <= 0.01 * len(rows)
    rude = toxicity.scored(spark.createDataFrame([(1, "What an IDIOT and moron!! You stupid clown.", 0, "")], DOCS), chain).first()
    assert rude.toxic and rude.p_insult > 0.5


def test_chain_passes_probabilities_on():
    r = np.random.default_rng(2)
    found = r.random((600, 3)) < 0.3
    first = found[:, 0].astype(int)
    second = (first & found[:, 1]).astype(int)
    weights = toxicity.fit_chain(found, np.column_stack([first, second]), np.arange(600) % toxicity.FOLDS)
    assert [len(w) for w in weights] == [4, 5]
    p = toxicity.Chain(("a", "b"), np.zeros(3, np.uint64), weights).probabilities(found)
    assert ((p[:, 0] > 0.5) == first).mean() > 0.95 and ((p[:, 1] > 0.5) == second).mean() > 0.95


def test_quality_held_out(tables):
    docs, labels = tables
    got = quality.scored(docs, quality.train(docs, labels)).select("row.doc_id", "held_out", "score", "predicted").join(labels, "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    assert len(rows) > 500 and np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= quality.GOOD) for r in rows)


def test_quality_learns_from_every_labelled_row(spark):
    """9,000 rows of either label, of which no sample of 3,000 has all; the model is the one that all of them give."""
    ids = [i for i in range(24000) if zlib.crc32(str(i).encode()) % 4 != 2]
    r = np.random.default_rng(4)
    text = {i: " ".join(["word" if r.random() < (0.75 if i % 2 else 0.25) else "#!" for _ in range(12)]) for i in ids}
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    got = quality.train(docs, labels)
    x, y = quality.table(pa.array([text[i] for i in ids])), np.array([i % 2 for i in ids])
    assert got.mean == pytest.approx(x.mean(0)) and got.scale == pytest.approx(x.std(0) + 1e-6)
    raw = np.sort(got.raw(x))
    weight = np.where(y == 1, y.mean() / y.sum(), (1 - y.mean()) / (1 - y).sum())[np.argsort(got.raw(x), kind="stable")]
    low = raw[np.searchsorted(np.cumsum(weight), 1 - y.mean() - 1e-12)]
    above = raw[raw > low + 1e-9]
    assert low - 1e-9 <= got.threshold <= (above[0] if len(above) else low) + 1e-9
    pairs = quality._pairs(quality._numbered(docs.join(labels, "doc_id").select("doc_id", "quality", F.array(F.col("doc_id").cast("double")).alias("x"))),
                           {1: int(y.sum()), 0: int((1 - y).sum())}).collect()
    assert {p[0][0] for p in pairs} | {p[1][0] for p in pairs} == set(map(float, ids))
    assert len(pairs) == quality.TURNS * max(y.sum(), (1 - y).sum()) == len({(p[0][0], p[1][0]) for p in pairs})


def test_scores_of_odd_rows(spark, tables):
    docs, labels = tables
    rows = [(None, None, 1, "s"), (1, "", 1, "s"), (1, "", 1, "s"), (2, " \n", None, None), (3, "long " * 50000, 1, ""), (4, "a", 1, "")]
    odd = spark.createDataFrame(rows, DOCS)
    ranker = quality.fit(quality.table(pa.array(["a fine text. of words", "||| !!! |||"])), np.array([1, 0]), 0.5)
    got = quality.scored(odd, ranker).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and got[0].row.score == "s"
    assert not any(r.held_out for r in got if r.row.doc_id is None)
    none = labels.limit(0)
    assert not any(r.toxic for r in toxicity.scored(odd, toxicity.train(docs.limit(0), none)).collect())
    assert {r.predicted for r in quality.scored(odd, quality.train(docs.limit(0), none)).collect()} == {0}
    chain = toxicity.train(docs, none)
    assert not any(r.toxic for r in toxicity.scored(odd, chain).collect())
    assert toxicity.scored(odd.limit(0), chain).collect() == []


def test_licences_of_every_family_and_of_none(spark, tables):
    docs, _ = tables
    scanner = licences.train(docs)
    texts = [(f, f"Some words first.\n\n{t.upper()}\nand then more.") for f, all_ in licences.TEMPLATES.items() for t in all_]
    rows = [(i, t, 0, "") for i, (_, t) in enumerate(texts)]
    other = [None, "", "\n", *licences.OTHER, "licensed", "the license", "Licensed under the moon by the sea, version two."]
    rows += [(1000 + i, t, 0, "") for i, t in enumerate(other)] + [(None, "Released under the MIT License.", 0, "")] * 2
    got = licences.scan(spark.createDataFrame(rows, DOCS), scanner).collect()
    assert sorted((r.doc_id, r.family) for r in got if r.doc_id is not None) == [(i, f) for i, (f, _) in enumerate(texts)]
    assert {r.paragraph for r in got if r.doc_id is not None} == {2}
    assert sum(r.doc_id is None and r.family == "MIT" for r in got) == 2


def test_licences_planted_in_the_table(spark):
    got = {(r.doc_id, r.paragraph) for r in QUERIES["op4_licences"](spark, SF).collect()}
    lines = licences.paragraphs(spark.read.parquet(f"{SF}/documents.parquet")).filter(F.lower("text").rlike("licensed under|released under"))
    assert got == {(r.doc_id, r.paragraph) for r in lines.collect()}


def test_licences_of_wrapped_notices(spark, tables):
    docs, _ = tables
    scanner = licences.train(docs)
    texts = [(f, textwrap.wrap(t, width)) for f, all_ in licences.TEMPLATES.items() for t in all_ for width in (30, 72, 80)]
    rows = [(i, "Some words first.\n\n" + "\n".join(f" * {x}" for x in lines) + "\n\nand then more.", 0, "") for i, (_, lines) in enumerate(texts)]
    rows += [(1000, "Released under the MIT License.\nLicensed under CC BY 4.0.", 0, "")]
    rows += [(None, "Licensed under the Mozilla Public\nLicense, version 2.0.", 0, "")] * 2
    got = licences.scan(spark.createDataFrame(rows, DOCS), scanner).collect()
    assert sorted((r.doc_id, r.family, r.paragraph) for r in got if r.doc_id is not None and r.doc_id < 1000) == [(i, f, 2) for i, (f, _) in enumerate(texts)]
    assert sorted((r.paragraph, r.family) for r in got if r.doc_id == 1000) == [(0, "MIT"), (1, "CC BY")]
    assert [r.family for r in got if r.doc_id is None] == ["MPL"] * 2


def test_licences_of_no_family_are_not_given_as_a_relative(spark, tables):
    docs, _ = tables
    scanner = licences.train(docs)
    strangers = [
        *licences.STRANGERS,
        "This library is licensed under the GNU Affero General Public License, version 3.",
        "All texts are licensed under CC BY-SA 4.0, see below.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License. Thank you.",
    ]
    denied = ["This work is not licensed under the MIT License.", "This software is not licensed under the GNU General Public License, version 3."]
    rows = [(i, f"Some words first.\n\n{t}\n\nand more.", 0, "") for i, t in enumerate(strangers)]
    rows += [(500 + i, t, 0, "") for i, t in enumerate(denied)] + [(600, "x\nSPDX-License-Identifier: MIT", 0, "")]
    got = {}
    for r in licences.scan(spark.createDataFrame(rows, DOCS), scanner).collect():
        got.setdefault(r.doc_id, []).append(r.family)
    assert [got.get(i) for i in range(len(strangers))] == [[licences.UNKNOWN]] * len(strangers)
    assert not any(set(got.get(500 + i, [])) & set(licences.FAMILIES) for i in range(len(denied)))
    assert got[600] == ["MIT"]


def test_licences_in_odd_tables(spark, tables):
    docs, _ = tables
    scanner = licences.train(docs)
    kind = "doc_id long, text string, hits int, family string"
    assert licences.scan(spark.createDataFrame([], kind), scanner).collect() == []
    long = "word " * 100_000 + "\nReleased under the MIT License.\n" + "more words\n" * 20_000
    got = licences.scan(spark.createDataFrame([(1, long, 5, "x"), (2, None, None, None)], kind), scanner).collect()
    assert [(r.doc_id, r.paragraph, r.family) for r in got] == [(1, 1, "MIT")]
    assert licences.train(docs.limit(0)).level >= licences.LEAST_LEVEL


def test_licences_learn_from_lines_of_all_documents(spark):
    """A phrase of most documents, none of them among the 400 with the smallest hash of their id, is known to be prose."""
    ids = [r.id for r in spark.range(1200).orderBy(F.xxhash64("id"), "id").collect()]
    phrase, plain = "Look, it was released under the MIT.", "An old tale of a boat and the sea."
    docs = spark.createDataFrame([(i, f"{plain} {i % 7}\n{phrase if n >= 400 else plain}\nNumber {i}", 0, "") for n, i in enumerate(ids)], DOCS)
    found = spark.createDataFrame([(1, f"{phrase}\n\nReleased under the MIT License.", 0, "")], DOCS)
    got = licences.scan(found, licences.train(docs)).collect()
    assert [(r.paragraph, r.family) for r in got] == [(2, "MIT")]


def test_licences_count_every_line(spark):
    rows = [(1, "The sea.\n\n!?\nThe sea.", 0, ""), (1, "The sea.\n\n!?\nThe sea.", 0, ""), (None, "A boat.\nCopyright 2020", 0, ""), (2, None, 0, ""), (3, "", 0, "")]
    got = licences.lines(spark.createDataFrame(rows, DOCS)).groupBy("terms").agg(F.sum("n").alias("n"), F.countDistinct("half").alias("halves")).collect()
    assert sorted((r.terms, r.n, r.halves) for r in got) == [(["a"], 1, 1), (["the"], 4, 1)]


def test_licences_templates_have_a_key_pair_where_they_hold():
    for own in licences.OWN:
        rest = set(own) - set(licences.KEYS)
        assert len(rest) / len(own) < licences.CONFIRM


def test_licences_split_as_spark_does(spark):
    notices = [t for c in licences.CLASSES for t in licences.NOTICES[c]]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(notices)], "i int, text string")
    words = licences.tokens(F.col("text"))
    got = rows.select("i", F.array_distinct(licences.pairs(words)).alias("own"), licences.terms(words).alias("terms")).collect()
    assert {r.i: r.own for r in got} == dict(enumerate(licences.OWN))
    assert all(set(r.own) < set(r.terms) <= {*licences.WORDS, *licences.PAIRS} and r.terms == sorted(set(r.terms)) for r in got)


def test_licences_plan_holds_no_expressions_of_every_template(spark):
    docs = spark.createDataFrame([(1, "The sea.\nReleased under the MIT License.", 0, "")], DOCS)
    plan = licences.scan(docs, licences.train(docs))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") < len(licences.CLASSES) and len(plan) < 100_000
