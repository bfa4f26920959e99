"""Fingerprints: edited texts and order against a plain version, likeness against sets of strings."""

import functools
import hashlib
import re
import string

import numpy as np
import pyarrow as pa
import pytest

from llm import spotsigs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@functools.cache
def is_anchor(word):
    return word in spotsigs.ANCHORS or int(spotsigs._word_hashes([word])[0]) % 4 == 0


def brute_set(text):
    words = [w.rstrip(string.punctuation) or w for w in WORDS.findall((text or "").translate(LOWER))]
    out, ahead = set(), []
    for w in reversed(words):
        if is_anchor(w):
            if len(ahead) == spotsigs.CHAIN:
                out.add((w, *ahead))
        else:
            ahead = [w, *ahead][: spotsigs.CHAIN]
    return out


def edited(text, after):
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def check(rows, texts):
    """texts: doc_id to text, distinct ids."""
    assert len(rows) == len(texts)
    order = sorted(texts, reverse=True)
    for i, key in enumerate(order):
        r = rows[key]
        text, after = texts[key] or "", texts[order[(i + 1) % len(order)]] or ""
        new = edited(text, after)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        for near, other in ((r.near_edited, new), (r.near_next, after)):
            a, b = brute_set(text), brute_set(other)
            if a and b:
                assert near == pytest.approx(len(a & b) / len(a | b), abs=1e-12)
            else:
                assert near == (not a and not b and text == other)


def fingerprints(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string")
    return spotsigs.fingerprints(df).collect()


def test_signatures_are_chains_after_anchors():
    text = "The cat. of the RED dog, and a bird! On green hills sat small people, in towns by wide rivers"
    (got,) = spotsigs.signature_sets(pa.array([text]))
    assert len(got) == len(brute_set(text)) >= 3
    assert len(spotsigs.signature_sets(pa.array(["", None, "the", "the cat"]))) == 4


def test_lengths_prune_only_hopeless_pairs():
    for least in (0.01, 0.3, 0.75):
        for a in range(1, 400):
            for b in range(a, 400, 7):
                if a / b >= least:
                    assert spotsigs.likeness(np.arange(a), np.arange(b), least) == pytest.approx(a / b)
    assert spotsigs.likeness(np.arange(2), np.arange(300), 0.5) == 0 < spotsigs.likeness(np.arange(2), np.arange(300))


def test_one_word_does_not_change_the_rule():
    text = " ".join(f"word{i}" for i in range(400))
    one, other = spotsigs.signature_sets(pa.array([f"{text} the x1 x2", f"{text} the x1 x3"]))
    assert spotsigs.likeness(one, other) > 0.9


def test_edges_of_buckets_and_odd_texts(spark):
    texts = {i * 3: t for i, t in enumerate(["", None, "é" * 7, "the cat sat on the mat of a man", "🙂 the x y z", "end of the line is here now"] * 6)}
    texts[-5] = "the last one is the first of all words here"
    rows = fingerprints(spark, [(i, t, "b") for i, t in texts.items()])
    check({r.doc_id: r for r in rows}, texts)
    marks = {}
    for r in rows:
        assert marks.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert len(set(marks.values())) == len(marks)


def test_single_repeated_missing_and_no_rows(spark):
    (one,) = fingerprints(spark, [(1, "abcd", "b")])
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    same = fingerprints(spark, [(1, "ab", "b"), (1, "ab", "b"), (None, "xy", "b"), (None, None, "b")])
    assert sorted(r.n_chars for r in same) == [0, 2, 2, 2]
    assert fingerprints(spark, []) == []


@pytest.mark.parametrize("common", ["the of and to in is was for on with that by", "the", ""])
def test_a_shared_half_counts_whatever_the_other_half_holds(spark, common):
    bare = " ".join(f"word{i}" for i in range(400))
    other = " ".join(f"{(common.split() or ['x'])[i % max(1, len(common.split()))]} thing{i} stuff{i}" if common != "the" or i == 7 else f"thing{i} stuff{i}" for i in range(200))
    rows = {r.doc_id: r for r in fingerprints(spark, [(2, bare, "b"), (1, other, "b")])}
    assert rows[2].near_edited > 0.2
    whole, half = spotsigs.signature_sets(pa.array([bare, bare + " " + other]))
    assert len(whole) and len(set(whole.tolist()) - set(half.tolist())) <= 2


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_over_a_whole_table(spark, sf):
    from llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check({r.doc_id: r for r in QUERIES["op5_spotsigs"](spark, sf).collect()}, texts)
