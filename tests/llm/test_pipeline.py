"""The stages of the corpus pipeline, each against a plain version of itself."""

from collections import Counter

import pytest

import corpus_pipeline
from test_debruijn import brute as without_repeats
from test_minhash import brute as near
from test_packing import covers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.store(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
        out[name] = docs.collect()
    return out


def test_toxic_documents_go(stages, spark):
    left = {r.doc_id for r in stages["toxicity"]}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, y in labels.items() if y == 0]
    assert sum(i in left for i in clean) >= 0.97 * len(clean)
    assert set(stages["toxicity"]) <= set(stages["documents"])


def test_one_of_each_group_stays(stages):
    texts = {r.doc_id: r.text for r in stages["toxicity"]}
    want = {i for i, (_, top) in near(texts).items() if i == top}
    assert Counter(stages["near_dedup"]) == Counter(r for r in stages["toxicity"] if r.doc_id in want)


def test_passages_go(stages):
    before = {r.doc_id: r for r in stages["near_dedup"]}
    want = dict(zip(before, without_repeats([r.text for r in before.values()]), strict=True))
    assert len(stages["substring_dedup"]) == len(before)
    for r in stages["substring_dedup"]:
        _, gone, kept = want[r.doc_id]
        old = before[r.doc_id]
        assert r == old if not gone else (r.text, r.n_chars, r.source) == (kept, len(kept), old.source)


def test_mixed_documents_are_packed(stages):
    times = Counter(r.doc_id for r in stages["mixing"])
    assert max(times.values()) <= 2 and set(stages["mixing"]) <= set(stages["substring_dedup"])
    texts = {r.doc_id: r.text for r in stages["mixing"]}
    single = [r for r in stages["packing"] if times[r.doc_id] == 1]
    assert Counter(r.doc_id for r in stages["packing"] if r.start == 0) == times
    tokens = {r.doc_id: r.doc_tokens for r in stages["packing"]}
    assert sum(r.length for r in stages["packing"]) == sum(tokens[i] * n for i, n in times.items())
    spans = {}
    for r in stages["packing"]:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert {r.doc_id for r in single} <= set(texts)


def test_missing_ids_and_repeated_rows(spark):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (None, "a b c d e f", None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    assert Counter(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()) == {1: 1, None: 2}
    kept = corpus_pipeline.drop_repeated_passages(spark, docs, SF)
    assert Counter(kept.collect()) == Counter(docs.collect())


def test_run_covers_a_small_corpus(spark):
    assert covers is not None and corpus_pipeline.ORACLE_SQL is None
    df = corpus_pipeline.run(spark, SF)
    assert df.columns[:2] == ["doc_id", "start"] and df.count() > 0
