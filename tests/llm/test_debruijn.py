"""Repeated windows against a brute-force count of word sequences."""

import hashlib
import random
import re
from collections import Counter

import pytest

from llm import debruijn

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts):
    words = [WORDS.findall(t or "") for t in texts]
    k = debruijn.WINDOW
    seen = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def run(spark, rows, schema="doc_id long, text string, extra string"):
    df = debruijn.remove_repeats(spark.createDataFrame(rows, schema))
    return df.select("rest.doc_id", "n_words", "n_removed", "kept_text").collect()


def check(spark, texts):
    got = {r[0]: tuple(r)[1:] for r in run(spark, [(i, t, "x") for i, t in enumerate(texts)])}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    return want


def test_shared_passages_and_copies(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}é" for i in range(300)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, longer = text(60), text(400)
    texts = [f"{text(r.randrange(80))}\n{passage}\t{text(r.randrange(80))}" for _ in range(40)]
    texts += [longer] * 5 + [text(500) for _ in range(10)]
    for cut in (34, 35, 36, 70):
        texts += [text(20) + " " + " ".join(longer.split()[100 : 100 + cut]) + " " + text(20)]
    edited = longer.split()
    for at in (10, 60, 61, 200, 399):
        edited[at] = "edit"
    texts.append(" ".join(edited))
    want = check(spark, texts)
    assert any(w[1] for w in want) and any(not w[1] for w in want)


def test_periodic_text_repeats_itself(spark):
    r = random.Random(4)
    texts = [
        "Shti " * 500,
        "one two three " * 60 + "end",
        "a b c d e f g h i j k " * 3,
        " ".join(f"u{i}" for i in range(90)),
        "x " * 34,
        "y " * 35,
        "z " * 36,
        " ".join(r.choice("ab") for _ in range(900)),
        "p q r s t u v w " * 40 + " ".join(f"v{i}" for i in range(50)) + " p q r s t u v w" * 40,
    ]
    check(spark, texts)


def test_nulls_empty_and_separators(spark):
    nbsp = " ".join("abcdefgh" * 10)  # not a separator
    lines = "\x0b".join(f"k{i}" for i in range(40)) + "\x0c\r\n"
    check(spark, [None, "", " \t\n", nbsp, lines, lines.replace("\x0b", " "), "\x1c".join("ab" * 40)])
    assert run(spark, []) == []


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"q{i}" for i in range(40))
    rows = [(1, text, "x"), (1, text, "x"), (None, "free " + text, "y"), (None, "short text", "y")]
    got = sorted((tuple(r) for r in run(spark, rows)), key=repr)
    assert [r[2] for r in got] == [40, 40, 0, 40]
    assert [r[3] for r in got] == ["", "", "short text", "free"]


def test_extra_columns_may_clash(spark):
    rows = [(1, "a b c", 5, [1], "s")]
    df = debruijn.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string, start int, spans array<int>, `rest.a` string")
    )
    assert df.select("rest.*").columns == ["doc_id", "start", "spans", "rest.a"]
    assert df.first()["kept_text"] == "a b c"


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_over_a_whole_table(spark, sf):
    from llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(texts, brute(texts.values()), strict=True))
    rows = QUERIES["op7_substring_dedup"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, gone, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
