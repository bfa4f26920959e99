"""Packing: ids against the tokenizer itself, and an exact cover of all ids."""

import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm import packing
from llm.words import blocks

ODD = [
    "Hello, world!! it's don't 'sam they'll x's. U.S.A. (a) [b]. c++ e-mail a_b 3.14 12345",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> A<|x|>. <| |>",
    "é é Ḱ. a̸. a≠ ΑΣ. ΣΑΣ! İ. ǅ, ß. ﬁ; 中文,abc。 a b c \x1c\x1d x\x00y",
    "", None, " \t\n\x0b\x0c\r", "...", "a...", "...a", "***", "the&&& ### $$$", "🙂🙂. 🙂a. a🙂.", "A" * 3000,
    "'", "''", "a'", "a'.", "a.'", "'s", "A'S.", "word'll.", "a<", "a>.", "a|.", "a.|",
]


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def test_ids_are_those_of_the_tokenizer():
    path = packing.public_vocabulary()
    tokenizer, own = Tokenizer.from_file(path), packing.Encoder(path)
    r = random.Random(1)
    parts = "ab .,'!<|>é̸́Σ9 \n -_s"
    texts = [*ODD, *("".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(3000))]
    for size in (200, 1 << 19):
        got = []
        for b in blocks(pa.array(texts, pa.string()), most=size):
            values, at = own.encode(b)
            got += [values[at[i] : at[i + 1]].tolist() for i in range(b.texts)]
        assert got == [ids(tokenizer, t) for t in texts]


def test_shortest_pack_first_places_every_length():
    r = random.Random(2)
    for _ in range(200):
        histogram = {r.randrange(1, 65): r.randrange(1, 1000) for _ in range(r.randrange(30))}
        patterns = packing.shortest_pack_first(histogram, 64)
        placed = Counter()
        for packs, lengths in patterns:
            assert sum(lengths) <= 64
            for n in lengths:
                placed[n] += packs
        assert placed == histogram and len(patterns) <= 3 * len(histogram)


def covers(rows, texts):
    """Every id in exactly one piece, sequences gapless from 0, sums right."""
    tokenizer = Tokenizer.from_file(packing.public_vocabulary())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, text in texts.items():
        want = ids(tokenizer, text)
        at = 0
        for r in sorted(pieces.pop(key), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            part = np.array(want[at : at + r.length], "<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(want)
    assert not pieces
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    assert sorted(sequences) == list(range(len(sequences)))


def test_packs_nulls_long_and_odd_texts(spark):
    texts = {i: t for i, t in enumerate([*ODD, "word " * 5000, "same text", "same text"])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 as length", "2 as rank")
    covers(packing.pack(df).collect(), texts)


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (None, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in got) == {1: 2, None: 2}
    assert sorted(r.offset for r in got) == [0, 3, 6, 9]
    empty = packing.pack(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == [] and empty.columns[-2:] == ["sequence_id", "offset"]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_over_a_whole_table(spark, sf):
    from llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    covers(QUERIES["op6_packing"](spark, sf).collect(), texts)


def test_the_cache_of_words_stays_small():
    """A word's text, hash and ids are no objects of their own: a dictionary of as many words took over 30 MB."""
    own = packing.Encoder(packing.public_vocabulary())
    for first in range(0, 300_000, 20_000):
        (b,) = blocks(pa.array([" ".join(f"w{i}" for i in range(first, first + 20_000))]))
        own.encode(b)
    size = lambda x: x.nbytes if isinstance(x, np.ndarray) else sys.getsizeof(x) + (64 * len(x) if isinstance(x, dict) else 0)
    assert own.at[300_000] > 300_000 and sum(size(x) for k, x in vars(own).items() if k != "tokenizer") < 24e6
