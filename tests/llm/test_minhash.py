"""Near-duplicates against all exact links, and the pieces of the method."""

import random
import re
import string

import pytest

from llm import minhash
from llm.tables import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = WORDS.findall((text or "").translate(LOWER))
    k = minhash.SHINGLE
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(texts):
    """texts: doc_id to text. All links, by an index of shingles."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= minhash.NEED * (len(s) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (len(sets[i]), top(i)) for i in texts}


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, signature string, id int")
    return minhash.near_duplicates(df).collect()


def agrees(rows, texts):
    want = brute(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def edit(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return words


def test_fewest_matches_keep_what_may_reach_the_threshold():
    least = [minhash.least_matches(n) for n in range(32, 129, 32)]
    assert least == sorted(least) and least[-1] < 0.75 * 128
    assert minhash.least_matches(32, miss=0.5) > minhash.least_matches(32, miss=1e-6)


def test_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # several blocks a bucket
    r = random.Random(7)
    word = lambda: f"w{r.randrange(5000)}"
    texts, key = {}, 100
    for size, edits in ((60, 3), (40, 6), (25, 9), (12, 1)):
        base = [word() for _ in range(120)]
        for _ in range(size):
            key += 1
            texts[key] = " ".join(edit(r, base, r.randrange(edits + 1)))
    chain = [word() for _ in range(150)]
    for _ in range(20):  # neighbours are near, ends are not
        key += 1
        chain = edit(r, chain, 2)
        texts[key] = " ".join(chain).upper()
    for _ in range(60):
        key += 1
        texts[key] = " ".join(word() for _ in range(r.randrange(1, 60)))
    agrees(run(spark, [(i, t, "s", 1) for i, t in texts.items()]), texts)


def test_nulls_short_texts_and_copies(spark):
    texts = {3: None, 5: "", 7: " \n", 9: "one two", 11: "ONE\ttwo", 13: "one two three", 15: "a b c d e f", 17: "a  b c d e f"}
    agrees(run(spark, [(i, t, None, None) for i, t in texts.items()]), texts)
    assert run(spark, []) == []


def test_repeated_rows_and_missing_ids(spark):
    rows = [(2, "a b c d e", "", 0), (2, "a b c d e", "", 0), (5, "v w x y z", "", 0), (5, "l m n o p", "", 0)]
    rows += [(4, "l m n o p", "", 0), (None, "v w x y z", "", 0), (None, "v w x y z", "", 0)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in run(spark, rows)), key=repr)
    assert got == sorted(
        [(2, 2, True)] * 2 + [(4, 4, True)] + [(5, 4, False)] * 2 + [(None, None, True)] * 2, key=repr
    )


def test_components_of_long_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(300, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}, 300: 200, 200: 200}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_over_a_whole_table(spark, sf):
    from llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    agrees(QUERIES["op2_minhash_dedup"](spark, sf).collect(), texts)
