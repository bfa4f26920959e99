"""Document fingerprints by SpotSigs: chains of content words that follow common-word anchors.

Each anchor of a text, with the next CHAIN words that are no anchors, is a signature; a document's
set of them ignores much of what navigation and lists repeat. Anchors are common words, and of all
other words a fixed quarter by their hash, so that texts without common words have signatures too.
That is one rule for every word of every text: a passage gives the same signatures whatever else
its text holds, and any two sets can be compared. Sets are partitioned by their length, and two of
them compared only if their lengths allow the likeness that is asked for; the comparison itself is
the Jaccard similarity of the full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from llm.tables import runs, shuffle_partitions
from llm.words import Block, blocks, byte_hashes, mix

CHAIN = 2
SLICE_BYTES = 1 << 21  # of text that is compared at once
SKETCH = 16  # smallest signatures shown in a fingerprint

# fixed values: common words of English, German, French and Spanish
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf aus das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au avec ce dans de des du en est et la le les pour que qui sur un une "
    "con del el es las los no para por se su una y"
).split()
_CLOSING = np.zeros(256, bool)
_CLOSING[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def _word_hashes(words: list[str]) -> np.ndarray:
    data = "".join(words).encode()
    at = np.cumsum([0, *(len(w.encode()) for w in words)])
    return np.unique(byte_hashes(np.frombuffer(data, np.uint8), at[:-1], at[1:]))


_ANCHOR_HASHES = _word_hashes(ANCHORS)


def stems(b: Block) -> np.ndarray:
    """Hashes of the words without closing ASCII punctuation; a word of nothing else stays whole."""
    if not len(b.end):
        return b.hash
    place = np.arange(len(b.data))
    end = np.maximum.accumulate(np.where(_CLOSING[b.data], -1, place))[b.end - 1] + 1
    return byte_hashes(b.data, b.start, np.where(end > b.start, end, b.end))


def anchors(words: np.ndarray) -> np.ndarray:
    """Which words, by their hashes, are anchors."""
    return np.isin(words, _ANCHOR_HASHES) | (words % np.uint64(4) == 0)


def _signatures(b: Block) -> list[np.ndarray]:
    """Sorted signatures of each text of a block."""
    words = stems(b)
    text = np.repeat(np.arange(b.texts), b.counts)
    anchor = anchors(words)
    content, spots = np.flatnonzero(~anchor), np.flatnonzero(anchor)
    first = np.searchsorted(content, spots)
    full = first + CHAIN <= len(content)
    spots, first = spots[full], first[full]
    same = text[content[first + CHAIN - 1]] == text[spots]
    spots, first = spots[same], first[same]
    value = mix(words[spots])
    for k in range(CHAIN):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + words[content[first + k]])
    at = np.searchsorted(text[spots], np.arange(b.texts + 1))
    return [np.unique(value[at[i] : at[i + 1]]) for i in range(b.texts)]


def signature_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted signatures of each text."""
    return [s for b in blocks(column, lower=True) for s in _signatures(b)]


def fingerprint(signatures: np.ndarray, text: str) -> str:
    """Length, digest and smallest members of a set; without signatures, the digest of the text."""
    if not len(signatures):
        return f"0-{hashlib.blake2b(text.encode(), digest_size=16).hexdigest() if text else ''}-"
    digest = hashlib.blake2b(signatures.tobytes(), digest_size=16).hexdigest()
    return f"{len(signatures)}-{digest}-{''.join(f'{x >> 32:08x}' for x in signatures[:SKETCH].tolist())}"


def part(length: int) -> int:
    """The partition of a set length: each is longer than the one before by half."""
    return int(math.log(length, 1.5)) if length else -1


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets, or 0 if their partitions are too far apart for ``least``."""
    if not len(a) or not len(b) or (least and abs(part(len(a)) - part(len(b))) > math.ceil(math.log(1 / least, 1.5))):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int]]:
    """Rows of a bucket in order, some at a time: those to compare, and the one that follows; guests come last."""
    for t in runs(batches, "bucket"):
        t = t.combine_chunks()
        own = len(t) - int(np.asarray(t["guest"]).sum())
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(t["text"]), 0), np.int64)[:own])
        first = 0
        while first < own:
            last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + SLICE_BYTES, "right")))
            yield t.slice(first, last + 1 - first), last - first
            first = last


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row against its edited text and the next row."""
    for t, own in _slices(batches):
        texts = [x or "" for x in t["text"].to_pylist()]
        edited = []
        for i in range(own):
            half = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
        sets = signature_sets(pa.array(texts[: own + 1], pa.large_string()))
        changed = signature_sets(pa.array(edited, pa.large_string()))
        marks = [fingerprint(s, x) for s, x in zip(sets, texts, strict=False)]
        new_marks = [fingerprint(s, x) for s, x in zip(changed, edited, strict=True)]

        def alike(i, marks_b, sets_b, j):
            return 1.0 if marks[i] == marks_b[j] else likeness(sets[i], sets_b[j])

        yield pa.RecordBatch.from_arrays(
            [
                t["doc_id"].slice(0, own).combine_chunks(),
                pa.array([len(x) for x in texts[:own]], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array(marks[:own], pa.string()),
                pa.array(new_marks, pa.string()),
                pa.array([alike(i, new_marks, changed, i) for i in range(own)], pa.float64()),
                pa.array([alike(i, marks, sets, i + 1) for i in range(own)], pa.float64()),
            ],
            names=[f.split()[0] for f in _RESULT.split(", ")],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each row of docs (doc_id, text, ...) with its fingerprint, and its likeness to two others.

    The edited text is the row's own with its last half, floor(n_chars / 2) code points, replaced
    by as many first ones of the next document, or all of them. The next document is that of the
    next smaller doc_id; rows that share one follow by a hash of their text, rows without one come
    last, and the first row follows the last. A null text is empty. Other columns are not read.

    Rows are dealt out once, by ranges of doc_id, so that neighbours meet; the last row of a range
    gets the first one of the next range as a guest. Quantiles of the ids choose the ranges, and
    one id per range passes through the driver.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("cuts")).first()["cuts"] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.arrow_udf("long")
    def bucket_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.where(ids.is_null(), -1, np.searchsorted(bounds, np.asarray(ids.fill_null(0)), "left")))

    tops = rows.select("doc_id", bucket_of("doc_id").alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("top"))
    order = sorted(((r["bucket"], r["top"]) for r in tops.collect()), reverse=True)
    host = {bucket: order[k - 1][0] for k, (bucket, _) in enumerate(order)}  # k = 0: the last bucket
    first = {bucket: top for bucket, top in order}
    place = {bucket: k for k, (bucket, _) in enumerate(order)}  # each bucket is a partition of its own

    @F.arrow_udf("array<struct<bucket:long,guest:boolean>>")
    def seats(ids: pa.Array) -> pa.Array:
        """A row's bucket, and the one whose last row it may follow."""
        out = []
        for i in ids.to_pylist():
            bucket = -1 if i is None else int(np.searchsorted(bounds, i, "left"))
            out.append([{"bucket": place[bucket], "guest": False}])
            if first[bucket] == i:
                out[-1].append({"bucket": place[host[bucket]], "guest": True})
        return pa.array(out, pa.list_(pa.struct([("bucket", pa.int64()), ("guest", pa.bool_())])))

    return (
        rows.select("doc_id", "text", seats("doc_id").alias("seats"))
        .select("doc_id", "text", F.explode("seats").alias("seat"))
        .select("seat.bucket", "seat.guest", "doc_id", "text")
        .repartitionById(max(len(order), 1), F.col("bucket").cast("int"))
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
        .mapInArrow(_compared, _RESULT)
    )
