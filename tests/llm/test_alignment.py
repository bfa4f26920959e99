"""Alignment: units against whole texts, fragments however they are cut, and brute-force sums."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm import alignment
from llm.words import _buffers

A, B = alignment.public_vocabularies()
ODD = [
    "Hello, world! it's don't we'll  two   spaces 3.14 a_b naïve café noir élan vital",
    "<|endoftext|> a<|endoftext|>b <s> </s> <unk> x", "a  b　 c  d é f", "▁a b", "日本 語 text 🙂 a 🙂🙂 b",
    "", None, " ", "  ", " a", "a ", "a  ", "\ta\n\nb \n c", "x" * 300, "a b " * 200, "a\x00b c\x1c d", "ﬁ Ⅷ x²", "é a", "Éa ß b ɏ c ʀ d",
]


@pytest.fixture(scope="module")
def own():
    return alignment.aligner(A, B)


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    aligner = alignment.aligner(A, B)

    def run(text):
        """(ids of A, ids of B, groups, links) of a whole text, by sets of byte places."""
        text = text or ""
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spelt = [b"".join(t[i] for i in ids) for t, ids in ((aligner.bytes_a, ids_a), (aligner.bytes_b, ids_b))]
        if not text or spelt != [(" " + text).encode()] * 2:
            return [], [], [], []
        ends_a = np.cumsum([len(aligner.bytes_a[i]) for i in ids_a]).tolist()
        ends_b = np.cumsum([len(aligner.bytes_b[i]) for i in ids_b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        inside = lambda ids, ends, lo, hi: [i for i, e in zip(ids, ends) if lo < e <= hi]
        groups = [(inside(ids_a, ends_a, lo, hi), inside(ids_b, ends_b, lo, hi)) for lo, hi in zip([0, *both], both)]
        owner = {p: j for j, (lo, hi) in enumerate(zip([0, *ends_b], ends_b)) for p in range(lo, hi)}
        links = [(ids_a[i], ids_b[j]) for i, (lo, hi) in enumerate(zip([0, *ends_a], ends_a)) for j in sorted({owner[p] for p in range(lo, hi)})]
        return ids_a, ids_b, groups, links

    return run


def digest(groups):
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if groups else ""


def samples(n, seed):
    r = random.Random(seed)
    parts = ["a", "B", "é", " ", "  ", "1", ".", "'s", "\n", "word", "ing", " the", "語", " ", "́", "<s>", "▁"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(n)]


def test_units_and_fragments_give_the_whole(own, plain):
    texts = [*ODD, *samples(1500, 1)]
    data, at = _buffers(pa.array(texts, pa.string()))
    sums, groups, (row, key, n) = own.texts(data, at)
    pairs = defaultdict(dict)
    for i, k, c in zip(row.tolist(), key.tolist(), n.tolist()):
        pairs[i][divmod(k, 1 << alignment.LOW)] = c
    r = random.Random(2)
    for i, text in enumerate(texts):
        ids_a, ids_b, want, links = plain(text)
        assert sums[i].tolist() == [bool(ids_a), len(ids_a), len(ids_b), len(want), len(links)], text
        assert alignment._digest(groups[i]) == digest(want)
        assert pairs[i] == Counter(links)
        raw = (text or "").encode()
        if len(raw) < 3 or i % 3:
            continue
        marks = sorted({0, len(raw), *(r.randrange(len(raw)) for _ in range(r.randrange(1, 8)))})
        pieces = [own.fragment(raw[x:y]) for x, y in zip(marks, marks[1:])]
        while len(pieces) > 1:  # any order of composition
            k = r.randrange(len(pieces) - 1)
            pieces[k : k + 2] = [own.compose(pieces[k], pieces[k + 1])]
        c = own.whole(pieces[0])
        assert [c.n_a, c.n_b, c.n_groups, c.n_links] == sums[i].tolist()[1:] and c.groups == groups[i]
        assert dict(zip((divmod(k, 1 << alignment.LOW) for k in c.pair.tolist()), c.count.tolist())) == Counter(links)


def expected(plain, rows):
    done = [(doc_id, plain(text)) for doc_id, text in rows]
    counts = Counter(link for _, x in done for link in x[3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (d, len(a), len(b), len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), digest(g))
            for d, (a, b, g, x) in done
        ),
        key=repr,
    )


@pytest.mark.parametrize("chunk", [7, 100, alignment.CHUNK])
def test_rows_against_brute_force(spark, rows, plain, chunk):
    texts = [*ODD, *samples(60, 3), "the same text " * 40, " ".join(samples(200, 4)), "y" * 2000]
    table = [(None if i % 9 == 0 else i // 2, t, "x", 5) for i, t in enumerate(texts)]
    table += [(77, "a third of all rows", "x", 5)] * 40 + [(None, None, None, None)] * 3
    docs = spark.createDataFrame(table, "doc_id long, text string, row string, n_a int")
    got = rows(alignment.align(docs, chunk=chunk), "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert got == expected(plain, [(r[0], r[1]) for r in table])


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs).collect() == []


def test_a_task_has_one_worker_for_long_texts(spark, monkeypatch):
    """Every worker holds both vocabularies, so no two steps follow each other without an exchange."""
    plans, real = [], alignment.store
    monkeypatch.setattr(alignment, "store", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a))
    rows = [(1, "ab " * 200 + "end"), (2, "x" * 300), (3, "ab"), (None, None)]
    out = alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string"), chunk=16)
    assert sorted(r.n_groups for r in out.collect())[0] == 0 and out.count() == 4
    for plan in plans:
        steps = [line.split("MapInArrow")[0] for line in plan.splitlines() if "MapInArrow" in line or "RepartitionByExpression" in line]
        assert all("Repartition" in a or "Repartition" in b for a, b in zip(steps, steps[1:])), plan
