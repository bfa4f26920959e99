"""Language-model scores of documents from a log-frequency Bloom filter of n-gram counts.

The counts of all words and word pairs of the training rows are quantised to powers of two. An
n-gram of level q goes into the filter q times, as (n-gram, 1) to (n-gram, q): probing 1, 2, ...
until a probe fails gives its level back, too high at worst. The filter grows with the n-grams it
holds, a fixed number of bits for each entry, in segments by n-gram hash that Spark tasks count and
build side by side. It is broadcast if it is small enough; else the n-grams travel to the segments,
each once for some megabytes of texts, which gives the same scores. A pair's probability is smoothed
by the word's own, from the levels alone. The base score rests on exact counts, which segments hold
beside the filter: they come with the levels, or, if the filter is broadcast, frequent words (at most
MOST_HEAVY) are so too and others meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from llm.tables import runs, shuffle_partitions, store
from llm.words import Block, blocks, mix

ENTRY_BITS = 10  # of the filter, for each entry
ENTRY_SET = 4  # of these are set, all in one 64-bit word
SEGMENT_TEXT = 1 << 22  # bytes of training text for each segment
KEY_BYTES = 5  # of an n-gram's hash in its segment
MOST_BROADCAST = 1 << 27  # bytes of a filter
MOST_HEAVY = 1 << 18  # frequent words: those that hold 1 / MOST_HEAVY of all tokens, or more
ROUTED = 8  # segments that one group of requests meets, 256 at most
ASKING_TEXT = 1 << 22  # bytes of texts that ask the segments together
PRIOR = 100.0  # strength of the word's own probability, in counts
BUFFER = 1 << 19  # n-grams that are counted at once

_START, _END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ROUND = 0xD6E8FEB86659FD93
_KEY = np.uint64((1 << 8 * KEY_BYTES) - 1)
_HEAD = mix(np.array([_START]) * _ONE)[0]  # a start as a word


@dataclass
class Grams:
    """Hashes of the n-grams that end at each place of some texts: a start, the words and an end each."""

    at: np.ndarray  # first place of each text, and the end
    head: np.ndarray  # whether a place is a text's start, which is no token
    one: np.ndarray
    two: np.ndarray


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x[:1], x[:-1]])


def grams(b: Block) -> Grams:
    at = np.concatenate([[0], np.cumsum(b.counts + 2)])
    token = np.empty(at[-1], np.uint64)
    inner = np.ones(len(token), bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    token[inner], token[at[:-1]], token[at[1:] - 1] = b.hash, _START, _END
    head = np.zeros(len(token), bool)
    head[at[:-1]] = True
    one = mix(token * _ONE)
    return Grams(at, head, one, mix(_before(one) * _TWO + one))


def probes(key: np.ndarray, number: int, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The word of a segment of ``size`` words that entry (key, number) lies in, and its bits there."""
    h = mix((key & _KEY) ^ np.uint64(number * _ROUND % (1 << 64)))
    bits = np.zeros(len(h), np.uint64)
    for i in range(ENTRY_SET):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return ((h >> np.uint64(32)) * np.asarray(size, np.uint64) >> np.uint64(32)).astype(np.int64), bits


def segment_of(key: np.ndarray, segments: int) -> np.ndarray:
    return ((key >> np.uint64(33)) % np.uint64(segments)).astype(np.int64)


def levels_of(n: np.ndarray) -> np.ndarray:
    """Numbers of binary digits."""
    return np.frexp(n.astype(np.float64))[1]


def fill(key: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A segment that holds these n-grams: its words."""
    words = np.zeros(max(1, -(-int(levels.sum()) * ENTRY_BITS // 64)), np.uint64)
    for number in range(1, int(levels.max(initial=0)) + 1):
        place, bits = probes(key[levels >= number], number, len(words))
        np.bitwise_or.at(words, place, bits)
    return words


@dataclass
class Filter:
    """Some segments, one behind the other."""

    words: np.ndarray
    at: np.ndarray  # bounds of the segments

    def levels(self, key: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Levels of n-grams: probes until one fails."""
        out, number = np.zeros(len(key), np.int64), 0
        base, size = self.at[segment], self.at[segment + 1] - self.at[segment]
        left = np.flatnonzero(size)
        while len(left) and number < 63:
            number += 1
            place, bits = probes(key[left], number, size[left])
            left = left[self.words[base[left] + place] & bits == bits]
            out[left] = number
        return out


def estimate(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the geometric mean of the least and the largest."""
    least = np.where(levels > 0, np.exp2(levels - 1.0), 0.0)
    return np.sqrt(least * np.maximum(2 * least - 1, 0))


Lookup = Callable[[np.ndarray], np.ndarray]


def scores(g: Grams, lookup: Lookup, tokens: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each text, and the levels of its words.

    With c as the counts that levels stand for: p1 = (c(w) + 1) / (tokens + words + 1), and
    p = (c(v w) + PRIOR * p1) / (c(v) + PRIOR) for a word w behind v. A pair is looked up only if
    both its words were found.
    """
    one = lookup(g.one)
    pair, two = known_pairs(g, one), np.zeros(len(one), np.int64)
    two[pair] = lookup(g.two[pair])
    return totals(g, one, two, tokens, words), one


def known_pairs(g: Grams, one: np.ndarray) -> np.ndarray:
    return ~g.head & (one > 0) & (_before(one) > 0)


def totals(g: Grams, one: np.ndarray, two: np.ndarray, tokens: int, words: int) -> np.ndarray:
    """log10 probability of each text by the levels of its words and known pairs."""
    p = (estimate(one) + 1) / (tokens + words + 1)
    context = _before(estimate(one))
    p = (np.minimum(estimate(two), context) + PRIOR * p) / (context + PRIOR)
    p[g.head] = 1
    return np.add.reduceat(np.log10(p), g.at[:-1])


@dataclass(frozen=True)
class Model:
    counts: DataFrame  # (key, n) of words
    filter: DataFrame  # (segment, words, key, n): the filter's words, and exact counts of the words of texts
    segments: int
    size: int  # bytes of the filter
    tokens: int
    words: int


def _buffered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Grams]]:
    held: list[Grams] = []
    size = 0
    for batch in batches:
        for b in blocks(batch.column(0), lower=True):
            held.append(grams(b))
            size += len(held[-1].one)
            if size > BUFFER:
                yield held
                held, size = [], 0
    if held:
        yield held


def _packed(key: np.ndarray) -> bytes:
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return out.reshape(-1).view("<u8")


def _parts(at: np.ndarray, found: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of each of ``found`` in sorted numbers."""
    return list(zip(np.searchsorted(at, found).tolist(), np.searchsorted(at, found, "right").tolist(), strict=True))


def _dealt(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """Words and pairs by segment, buffer by buffer: whole words and how often they occur; pairs that occur once there, the others, and how often they do."""
    for held in _buffered(batches):
        word, times = np.unique(np.concatenate([g.one for g in held]), return_counts=True)
        pair, n = np.unique(np.concatenate([g.two[~g.head] for g in held]), return_counts=True)
        word_at, pair_at = segment_of(word, segments), segment_of(pair, segments)
        order = np.argsort(word_at, kind="stable")
        word, times, word_at = word[order], times[order], word_at[order]
        order = np.argsort(2 * pair_at + (n > 1), kind="stable")
        pair, n, pair_at = pair[order], n[order], pair_at[order]
        found = np.flatnonzero(np.bincount(word_at, minlength=segments) + np.bincount(pair_at, minlength=segments))
        words, more = _parts(word_at, found), np.concatenate([[0], np.cumsum(n > 1)])
        parts = [(i, j - int(more[j] - more[i]), j) for i, j in _parts(pair_at, found)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found),
                pa.array([word[i:j].astype("<u8").tobytes() for i, j in words], pa.binary()),
                pa.array([times[i:j].astype("<u4").tobytes() for i, j in words], pa.binary()),
                pa.array([_packed(pair[i:k]) for i, k, _ in parts], pa.binary()),
                pa.array([_packed(pair[k:j]) for _, k, j in parts], pa.binary()),
                pa.array([n[k:j].astype("<u4").tobytes() for _, k, j in parts], pa.binary()),
            ],
            names=["segment", "word", "word_times", "once", "keys", "times"],
        )


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in runs(batches, "segment"):
        word, word_times, once, keys, times = (b"".join(group.column(c).to_pylist()) for c in ("word", "word_times", "once", "keys", "times"))
        word, place = np.unique(np.frombuffer(word, "<u8"), return_inverse=True)
        count = np.bincount(place, np.frombuffer(word_times, "<u4"), len(word)).astype(np.int64)
        one, other = _unpacked(once), _unpacked(keys)
        n = np.concatenate([count, np.ones(len(one), np.int64), np.frombuffer(times, "<u4").astype(np.int64)])
        key, place = np.unique(np.concatenate([word & _KEY, one, other]), return_inverse=True)
        words, token = fill(key, levels_of(np.bincount(place, n))), word != _HEAD
        yield pa.RecordBatch.from_arrays(
            [
                group.column("segment")[:1].combine_chunks(),
                pa.array([words.tobytes()], pa.binary()),
                pa.array([word[token].view(np.int64)], pa.list_(pa.int64())),
                pa.array([count[token]], pa.list_(pa.int64())),
            ],
            names=["segment", "words", "key", "n"],
        )


def train(docs: DataFrame) -> Model:
    """Exact counts of the words of docs (text, ...), and the filter. No rows give an empty filter."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    segments = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SEGMENT_TEXT
    kind = "segment long, word binary, word_times binary, once binary, keys binary, times binary"
    dealt = texts.mapInArrow(lambda batches: _dealt(batches, segments), kind)
    dealt = dealt.repartition(shuffle_partitions(docs.sparkSession), "segment").sortWithinPartitions("segment")
    made = store(dealt.mapInArrow(_filled, "segment long, words binary, key array<long>, n array<long>"), "filter")
    in_segment = F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)
    size, tokens, words = made.agg(F.sum(F.octet_length("words")), F.sum(in_segment), F.sum(F.size("n"))).first()
    counts = made.select(F.explode(F.arrays_zip("key", "n")).alias("count")).select("count.*")
    return Model(counts, made, segments, size or 0, tokens or 0, words or 0)


_SCORED = "row long, doc_id long, learned boolean, n_tokens long, score double, known long, gain double, items array<struct<key:long,n:long>>"


@dataclass
class Scorer:
    """What every task holds: the numbers of tokens and words, and the exact counts of frequent words."""

    tokens: int
    words: int
    key: np.ndarray
    n: np.ndarray

    def batch(self, batch: pa.RecordBatch, first: int, g: Grams, lookup: Lookup) -> pa.RecordBatch:
        """Rows (row, doc_id, learned, ...) with the scores of their texts, sums over frequent words, and other known words."""
        n = len(g.at) - 1
        values, one = scores(g, lookup, self.tokens, self.words)
        place = np.minimum(np.searchsorted(self.key, g.one), len(self.key) - 1)
        heavy = (self.key[place] == g.one) & ~g.head
        gain = np.where(heavy, np.log10(self.n[place] + 1.0), 0.0)
        rest = ~g.head & ~heavy & (one > 0)
        text = np.repeat(np.arange(n), np.diff(g.at))[rest]
        kinds, word = np.unique(g.one[rest], return_inverse=True)
        pair, times = np.unique(text * np.int64(1 << 32) + word, return_counts=True)
        text, word = np.divmod(pair, np.int64(1 << 32))
        items = pa.StructArray.from_arrays([pa.array(kinds[word].view(np.int64)), pa.array(times)], names=["key", "n"])
        bounds = pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                *(batch.column(i).slice(first, n) for i in range(3)),
                pa.array(np.diff(g.at) - 1),
                pa.array(values),
                pa.array(np.add.reduceat(heavy.astype(np.int64), g.at[:-1])),
                pa.array(np.add.reduceat(gain, g.at[:-1])),
                pa.ListArray.from_arrays(bounds, items),
            ],
            names=["row", "doc_id", "learned", "n_tokens", "score", "known", "gain", "items"],
        )


def _by_broadcast(rows: DataFrame, model: Model, scorer: Scorer) -> DataFrame:
    """Rows (row, doc_id, learned, text) scored by tasks that hold the whole filter."""
    parts = [b""] * model.segments
    for r in model.filter.select("segment", "words").toLocalIterator():
        parts[r["segment"]] = bytes(r["words"])
    at = np.cumsum([0, *(len(p) // 8 for p in parts)])
    # as plain bytes, which a worker reads into place; an array would be copied once more
    held, segments = rows.sparkSession.sparkContext.broadcast(b"".join(parts)), model.segments
    del parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Filter(np.frombuffer(held.value, np.uint64), at)
        for batch in batches:
            for b in blocks(batch.column(3), lower=True):
                yield scorer.batch(batch, b.first, grams(b), lambda key: whole.levels(key, segment_of(key, segments)))

    return rows.mapInArrow(run, _SCORED)


def _whole(texts: pa.ChunkedArray) -> Grams:
    """The n-grams of all these texts."""
    held = [grams(b) for b in blocks(texts, lower=True)]
    at = np.cumsum(np.concatenate([[0], *(np.diff(g.at) for g in held)]))
    return Grams(at, *(np.concatenate([getattr(g, c) for g in held]) for c in ("head", "one", "two")))


@dataclass
class Kinds:
    """Distinct n-grams by segment and hash, so that they are the same at any time, and where each of some places has its own."""

    key: np.ndarray
    segment: np.ndarray
    place: np.ndarray


def _kinds(keys: np.ndarray, segments: int) -> Kinds:
    key, place = np.unique(keys, return_inverse=True)
    segment = segment_of(key, segments)
    order = np.argsort(segment, kind="stable")
    rank = np.empty(len(key), np.int64)
    rank[order] = np.arange(len(key))
    return Kinds(key[order], segment[order], rank[place])


class _Group:
    """What answers requests: the filter of some segments, and the exact counts of their words."""

    def __init__(self, parts: dict[int, tuple[bytes, np.ndarray, np.ndarray]], segments: int, routed: int):
        own = [np.frombuffer(parts[i][0], np.uint64) if i in parts else np.zeros(0, np.uint64) for i in range(routed)]
        self.filter = Filter(np.concatenate(own), np.concatenate([[0], np.cumsum([len(w) for w in own])]))
        key, n = (np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts.values())]) for i in (1, 2))
        order = np.argsort(key.view(np.uint64))
        self.key, self.n = key.view(np.uint64)[order], n[order]
        self.segments, self.routed = segments, routed

    def answers(self, asks: list[tuple[bytes, bytes, bytes]]) -> Iterator[tuple[bytes, bytes, bytes]]:
        """Levels and exact counts of the words, and levels of the pairs, of each request (words, pairs, their segments)."""
        word, pair, place = (b"".join(x) for x in zip(*asks, strict=True))
        word, place = np.frombuffer(word, "<u8"), np.frombuffer(place, np.uint8).astype(np.int64)
        word_levels = self.filter.levels(word, segment_of(word, self.segments) % self.routed).astype(np.uint8)
        pair_levels = self.filter.levels(_unpacked(pair), place).astype(np.uint8)
        counts = exact(self.key, self.n, word)
        i = j = 0
        for words, _, places in asks:
            m, n = len(words) // 8, len(places)
            yield word_levels[i : i + m].tobytes(), counts[i : i + m].astype("<i8").tobytes(), pair_levels[j : j + n].tobytes()
            i, j = i + m, j + n


def exact(key: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of words by sorted keys; 0 for others."""
    if not len(key):
        return np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
    return np.where(key[place] == wanted, n[place], 0)


def _asks(texts: DataFrame, segments: int, routed: int) -> DataFrame:
    """Requests (group, block, word, pair, place) of texts (block, text, ...): one of a block to a group of segments."""

    def asked(block: pa.Table) -> pa.Table:
        g = _whole(block.column("text"))
        word, pair = _kinds(g.one, segments), _kinds(g.two[~g.head], segments)
        word_at, pair_at = word.segment // routed, pair.segment // routed
        groups = np.flatnonzero(np.bincount(word_at, minlength=segments) + np.bincount(pair_at, minlength=segments))
        words, pairs = _parts(word_at, groups), _parts(pair_at, groups)
        own = (pair.segment % routed).astype(np.uint8)
        return pa.table(
            {
                "group": pa.array(groups),
                "block": pa.array([block.column("block")[0].as_py()] * len(groups), pa.int64()),
                "word": pa.array([word.key[i:j].astype("<u8").tobytes() for i, j in words], pa.binary()),
                "pair": pa.array([_packed(pair.key[i:j]) for i, j in pairs], pa.binary()),
                "place": pa.array([own[i:j].tobytes() for i, j in pairs], pa.binary()),
            }
        )

    return texts.groupBy("block").applyInArrow(asked, "group long, block long, word binary, pair binary, place binary")


def _in_blocks(rows: DataFrame, asking: int) -> DataFrame:
    """Rows dealt into blocks of about ``asking`` bytes of text, by row."""
    n = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // asking
    return rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n))).repartition(shuffle_partitions(rows.sparkSession), "block")


def _by_route(rows: DataFrame, model: Model, routed: int, asking: int) -> DataFrame:
    """Rows (row, doc_id, learned, text) scored with levels and counts that their n-grams bring from the segments.

    A block of texts asks each group of ``routed`` segments once, for each n-gram once; a task holds
    one group at a time. The shuffle that deals the texts serves both the requests and the scores.
    """
    segments, tokens, kinds = model.segments, model.tokens, model.words
    texts = _in_blocks(rows, asking)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, tuple[bytes, np.ndarray, np.ndarray]] = {}
        at, held = None, None
        asks: list[tuple[int, bytes, bytes, bytes]] = []

        def told() -> pa.RecordBatch:
            got = [(at, a[0], *x) for a, x in zip(asks, held.answers([a[1:] for a in asks]), strict=True)]
            asks.clear()
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*got, strict=True), types, strict=True)],
                names=["group", "block", "word_levels", "word_n", "pair_levels"],
            )

        for batch in batches:
            size = 0
            for i, (group, block) in enumerate(zip(batch.column("group").to_pylist(), batch.column("block").to_pylist(), strict=True)):
                if group != at:
                    if asks:
                        yield told()
                    own, at, held, size = {}, group, None, 0
                if block is None:
                    key, n = (np.asarray(batch.column(c)[i].values) for c in ("key", "n"))
                    own[batch.column("segment")[i].as_py() % routed] = batch.column("words")[i].as_py(), key, n
                    continue
                if held is None:
                    held = _Group(own, segments, routed)
                asks.append((block, *(batch.column(c)[i].as_py() for c in ("word", "pair", "place"))))
                size += len(asks[-1][3])
                if size > BUFFER:
                    yield told()
                    size = 0
            if asks:
                yield told()

    def scored(block: pa.Table, answers: pa.Table) -> pa.Table:
        g = _whole(block.column("text"))
        word, pair = _kinds(g.one, segments), _kinds(g.two[~g.head], segments)
        answers = answers.sort_by("group")
        word_levels, word_n, pair_levels = (
            np.frombuffer(b"".join(answers.column(c).to_pylist()), t) for c, t in (("word_levels", "u1"), ("word_n", "<i8"), ("pair_levels", "u1"))
        )
        if len(word_levels) != len(word.key) or len(pair_levels) != len(pair.key):
            raise RuntimeError("texts were dealt otherwise when they asked")
        one, two = word_levels[word.place].astype(np.int64), np.zeros(len(g.one), np.int64)
        two[~g.head] = pair_levels[pair.place]
        score = totals(g, one, np.where(known_pairs(g, one), two, 0), tokens, kinds)
        count = np.where(g.head, 0, word_n[word.place])
        known, gain = (np.add.reduceat(x, g.at[:-1]) for x in ((count > 0).astype(np.int64), np.log10(count + 1.0)))
        doc_id, learned = block.column("doc_id"), block.column("learned")
        return pa.table({"doc_id": doc_id, "learned": learned, "n_tokens": np.diff(g.at) - 1, "known": known, "gain": gain, "score": score})

    asks = _asks(texts, segments, routed)
    held = model.filter.withColumn("group", F.floor(F.col("segment") / routed))
    both = held.unionByName(asks, allowMissingColumns=True).repartition(shuffle_partitions(rows.sparkSession), "group").sortWithinPartitions("group", F.col("block").asc_nulls_first())
    answers = both.mapInArrow(answered, "group long, block long, word_levels binary, word_n binary, pair_levels binary")
    kind = "doc_id long, learned boolean, n_tokens long, known long, gain double, score double"
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, kind)


def _broadcast(rows: DataFrame, model: Model, heavy: int) -> DataFrame:
    """Rows (row, doc_id, learned, text) scored by the whole filter, with the exact counts of frequent words; those of others are joined."""
    often = F.col("n") * heavy >= F.lit(model.tokens)
    frequent = model.counts.filter(often).toArrow()  # ``heavy`` rows of two numbers at most
    key, n = (np.asarray(frequent[c].combine_chunks()) for c in ("key", "n"))
    key, n = (key.astype(np.int64).view(np.uint64), n) if len(key) else (np.zeros(1, np.uint64), np.zeros(1, np.int64))
    order = np.argsort(key)
    scored = store(_by_broadcast(rows, model, Scorer(model.tokens, model.words, key[order], n[order])), "scored")
    items = scored.select("row", F.explode("items").alias("item")).select("row", "item.*")
    rare = model.counts.filter(~often).select("key", F.col("n").alias("count"))
    sums = items.join(rare, "key").groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("count") + 1)).alias("more_gain"))
    known, gain = F.col("known") + F.coalesce("more", F.lit(0)), F.col("gain") + F.coalesce("more_gain", F.lit(0.0))
    return scored.join(sums, "row", "left").withColumns({"known": known, "gain": gain})


def score(
    docs: DataFrame, model: Model, learned: Column, most: int = MOST_BROADCAST, routed: int = ROUTED, heavy: int = MOST_HEAVY, asking: int = ASKING_TEXT
) -> DataFrame:
    """Every row's doc_id, learned, n_tokens, n_known, train_tokens, base_score and score.

    Texts are lower-cased A-Z; their tokens are words and one end. A null or empty text is its end
    alone. ``learned`` is handed through. Repeated rows, and rows without a doc_id, are scored each
    for itself. A filter of over ``most`` bytes isn't broadcast; the scores are the same. A model
    without tokens gives every token the probability 1. At most ``heavy`` words are broadcast with
    their exact counts. Columns but doc_id and text are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), learned.alias("learned"), F.col("text").cast("string"))
    scored = _broadcast(rows, model, heavy) if model.size <= most else _by_route(rows, model, routed, asking)
    return scored.select(
        "doc_id", "learned", "n_tokens", F.col("known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("gain") - F.col("n_tokens") * F.log10(F.lit(float(model.tokens + model.words + 1)))).alias("base_score"), "score",
    )


def held_out(share: int = 7, rest: int = 2) -> Column:
    """Rows that a model doesn't learn from, by the checksum of their id; a row without an id is learnt."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % share == rest, F.lit(False))
