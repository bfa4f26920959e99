"""Packing of tokenised documents into sequences by shortest-pack-first over the length histogram.

A document's ids are cut every SEQUENCE ids; what remains is its last piece. The histogram of
piece lengths has at most SEQUENCE entries, whatever the corpus, and packing works on it alone:
from the longest length down, pieces go to the pack that is least full, many equal packs at a
time. The outcome is a bounded list of packing patterns with counts. Each pattern's slots take
consecutive ranks of their length, so a piece finds its sequence from its length and rank.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from llm.tables import shuffle_partitions, store
from llm.words import LOWER, Block, blocks, byte_hashes

SEQUENCE = 2048
END = 1  # closes every document
MOST_WORDS = 1 << 20  # of a worker's cache, about 40 bytes each; it is then emptied. Workers keep it between stages
AT_ONCE = 1 << 12  # words that are encoded at once
_TAIL = np.zeros(256, bool)  # ASCII punctuation that a vocabulary always parts from a letter before it
_TAIL[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<|>"]] = True


class Encoder:
    """Ids of texts for a vocabulary that never looks across white space; each word is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.hash = np.zeros(0, np.uint64)  # of the known words, sorted
        self.number = np.zeros(0, np.int32)  # of these words, as they were learned
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)

    def learn(self, words: list[str], old: int) -> None:
        """Encode words that get the numbers from ``old`` on."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        ends = self.at[old] + np.cumsum([len(x) for x in ids])
        while len(self.at) <= old + len(ids):
            self.at = np.append(self.at, np.zeros_like(self.at))
        while len(self.ids) < ends[-1]:
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[self.at[old] : ends[-1]] = np.fromiter((i for x in ids for i in x), np.uint32, ends[-1] - self.at[old])
        self.at[old + 1 : old + 1 + len(ids)] = ends

    def encode(self, b: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a block, each with END, and the bounds of the texts in them."""
        if len(self.hash) > MOST_WORDS:
            self.clear()
        word_start, word_end, unit_at = units(b)
        data = b.data.tobytes()
        if b"<|" not in data:  # a special token's name is told apart by its case
            data = LOWER[b.data].tobytes()
        hashes = byte_hashes(np.frombuffer(data, np.uint8), word_start, word_end)
        kinds, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, kinds)
        old = len(self.hash)
        known = np.zeros(len(kinds), bool)
        inner = place < old
        known[inner] = self.hash[place[inner]] == kinds[inner]
        new = np.flatnonzero(~known)
        for k in range(0, len(new), AT_ONCE):
            some = first[new[k : k + AT_ONCE]].tolist()
            self.learn([data[word_start[i] : word_end[i]].decode() for i in some], old + k)
        self.hash = np.insert(self.hash, place[new], kinds[new])
        self.number = np.insert(self.number, place[new], np.arange(old, old + len(new)))
        number = self.number[np.searchsorted(self.hash, kinds)][kind]
        start, size = self.at[number], self.at[number + 1] - self.at[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        bounds = ends[unit_at] + np.arange(b.texts + 1)
        out = np.full(bounds[-1], END, np.uint32)
        shift = start - ends[:-1]
        place = np.ones(len(out), bool)
        place[bounds[1:] - 1] = False
        out[place] = self.ids[np.arange(ends[-1]) + np.repeat(shift, size)]
        return out, bounds


def units(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of what is encoded alone, and the bounds of the texts in it.

    Units are words, but a word's closing punctuation after an ASCII letter is one of its own.
    """
    place = np.arange(len(b.data))
    stem = np.maximum.accumulate(np.where(_TAIL[b.data], -1, place))[b.end - 1] + 1 if len(b.end) else b.end
    split = (stem > b.start) & (stem < b.end)
    split[split] = np.isin(LOWER[b.data[stem[split] - 1]], np.arange(ord("a"), ord("z") + 1))
    at = np.concatenate([[0], np.cumsum(1 + split)])
    start, end = np.empty(at[-1], np.int64), np.empty(at[-1], np.int64)
    start[at[:-1]], end[at[1:] - 1] = b.start, b.end
    end[at[:-1][split]] = start[at[:-1][split] + 1] = stem[split]
    return start, end, at[b.word_at]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens) of all rows of docs (doc_id, text, ...)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary or public_vocabulary()).encode
        for batch in batches:
            for b in blocks(batch.column(1)):
                ids, at = encode(b)
                tokens = np.diff(at)
                number = -(-tokens // SEQUENCE)
                row = np.repeat(np.arange(b.texts), number)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * SEQUENCE
                length = np.minimum(tokens[row] - start, SEQUENCE)
                data, place = ids.astype("<u4").tobytes(), at[row] + start
                sums = [zlib.crc32(data[4 * p : 4 * (p + n)]) for p, n in zip(place.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(b.first, b.texts).take(pa.array(row)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                        pa.array(tokens[row]),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces, kind)


def shortest_pack_first(histogram: dict[int, int], most: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """Packing patterns (number of packs, lengths in one pack) that place every length so often.

    A length that fits nowhere opens packs and fills them one after the other. At most three
    patterns per length arise: it splits one, and opens full packs and one less full.
    """
    heap: list[tuple[int, int, int, tuple[int, ...]]] = []  # least full first
    serial = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            times = 1
            if heap and heap[0][0] + length <= most:
                full, _, packs, lengths = heapq.heappop(heap)
            else:
                times = min(left, most // length)
                full, packs, lengths = 0, left // times, ()
            used = min(left, packs)
            if used < packs:
                heapq.heappush(heap, (full, (serial := serial + 1), packs - used, lengths))
            heapq.heappush(heap, (full + times * length, (serial := serial + 1), used, (*lengths, *[length] * times)))
            left -= used * times
    return [(packs, list(lengths)) for _, _, packs, lengths in sorted(heap)]


def slots(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, equal pieces per pack, first sequence, offset), sorted.

    A pack's equal lengths share a slot. A pack has at most 63 different lengths, so there are
    fewer than 64 slots per pattern, whatever the corpus.
    """
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for packs, lengths in patterns:
        offset = 0
        for length in dict.fromkeys(lengths):
            number = lengths.count(length)
            out.append((length, taken.get(length, 0), number, sequence, offset))
            taken[length] = taken.get(length, 0) + packs * number
            offset += number * length
        sequence += packs
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with their rank among those of equal length, from 0.

    Ranks are counted within hashed parts of a length and shifted by the parts before, since a
    length may hold a third of all pieces.
    """
    parts = shuffle_partitions(pieces.sparkSession)
    key = ["doc_id", "start", "ids_crc32"]
    salted = pieces.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        salted.groupBy("length", "part").count()
        .select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    )
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy(*key))
    return (
        salted.withColumn("rank", within - 1)
        .join(shifts, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("shift"))
        .drop("part", "shift")
    )


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all rows of docs (doc_id, text, ...) with their sequence and their offset there.

    A null text is empty: its only id is END. Rows that repeat a document, or have no doc_id, are
    packed each for itself. Other columns are not read. Sequence ids count from 0 without gaps,
    and a sequence is filled from offset 0 without gaps.
    """
    pieces = store(cut(docs, vocabulary), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = slots(shortest_pack_first(histogram))
    wide = np.int64(1 << 44)  # more than there are pieces of a length
    begin = table[:, 0] * wide + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            slot = table[np.searchsorted(begin, length * wide + rank, "right") - 1].reshape(-1, 5)
            turn, at = np.divmod(rank - slot[:, 1], slot[:, 2])
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(slot[:, 3] + turn), pa.array(slot[:, 4] + at * length)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("rank").cast("long")).mapInArrow(place, kind)
