"""Removal of long word sequences that repeat anywhere in a corpus, by compacting its De Bruijn graph.

Edges of the graph are runs of ``WINDOW`` consecutive words of one document, from the node of
their first to that of their last ``WINDOW - 1`` words. Neighbouring edges that share a minimizer
(the smallest hash among their ``ANCHOR``-word runs, which is their anchor) are compacted to one
path where they are read, so the corpus shuffles about one row per 14 words and never one per
word. An edge's anchor depends on its words only: an edge can repeat only in paths of its anchor.

Joins then tell the paths of repeated anchors apart. Paths that occur again in full are repeated
from end to end. Where an anchor has several paths, the graph branches somewhere inside: one
occurrence of each such path is opened into its edges, read again at its source coordinates, and
these are counted. Removed are the words of all repeated edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from llm.tables import shuffle_partitions, store
from llm.words import CHECK_POWERS, WORD_POWERS, Block, blocks

WINDOW = 35
ANCHOR = 8


def anchors(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each edge of a block its first word, anchor and the anchor's place, and the texts' bounds."""
    first, bounds = b.windows(WINDOW)
    n = len(b.hash)
    value = np.full(n + WINDOW, np.iinfo(np.uint64).max, np.uint64)
    short, _ = b.windows(ANCHOR)
    value[short] = WORD_POWERS.spans(b.hash, short, short + ANCHOR)
    place = np.arange(n + WINDOW)
    span, width = 1, WINDOW - ANCHOR + 1
    while span < width:  # minima over twice as many places each time; of equal ones the leftmost
        step = min(span, width - span)
        later, at = value[step:], place[step:]
        less = later < value[:-step]
        value, place = np.where(less, later, value[:-step]), np.where(less, at, place[:-step])
        span += step
    return first, value[first], place[first], bounds


_PATH = "doc_key long, uid long, start int, edges int, anchor long, path_a long, path_b long, again boolean"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compacted paths of a batch (doc_key, uid, text)."""
    for batch in batches:
        keys, uids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        for b in blocks(batch.column(2)):
            first, value, place, bounds = anchors(b)
            if not len(first):
                continue
            new = np.ones(len(first), bool)
            new[1:] = value[1:] != value[:-1]
            new[bounds[:-1][bounds[:-1] < len(first)]] = True
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(first)) - 1
            edges = last - at + 1
            start, end = first[at], first[last] + WINDOW
            row = b.first + np.searchsorted(bounds, at, "right") - 1
            text_start = b.word_at[row - b.first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[row]),
                    pa.array(uids[row]),
                    pa.array((start - text_start).astype(np.int32)),
                    pa.array(edges.astype(np.int32)),
                    pa.array(value[at].view(np.int64)),
                    pa.array(WORD_POWERS.spans(b.hash, start, end).view(np.int64)),
                    pa.array(CHECK_POWERS.spans(b.hash, start, end).view(np.int64)),
                    pa.array(place[at] != place[last]),
                ],
                names=["doc_key", "uid", "start", "edges", "anchor", "path_a", "path_b", "again"],
            )


class _Lists:
    """A nested list column of integer structs as flat arrays and bounds."""

    def __init__(self, column: pa.Array, *fields: str):
        counts = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(counts)])
        flat = column.flatten()
        self.fields = [np.asarray(flat.field(f)) for f in fields]

    def rows(self, first: int, last: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Row numbers from 0 of the entries of some rows, and their fields."""
        a, b = self.at[first], self.at[last]
        counts = np.diff(self.at[first : last + 1])
        return np.repeat(np.arange(last - first), counts), [f[a:b] for f in self.fields]


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the listed paths of each text."""
    for batch in batches:
        keys, uids = np.asarray(batch.column("doc_key")), np.asarray(batch.column("uid"))
        lists = _Lists(batch.column("paths"), "start", "edges", "anchor", "n")
        for b in blocks(batch.column("text")):
            row, (start, edges, anchor, n) = lists.rows(b.first, b.first + b.texts)
            if not len(row):
                continue
            path = np.repeat(np.arange(len(row)), edges)
            step = np.arange(len(path)) - np.repeat(np.cumsum(edges) - edges, edges)
            word = (b.word_at[row] + start)[path] + step
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[b.first + row[path]]),
                    pa.array(uids[b.first + row[path]]),
                    pa.array((start[path] + step).astype(np.int32)),
                    pa.array(anchor[path]),
                    pa.array(WORD_POWERS.spans(b.hash, word, word + WINDOW).view(np.int64)),
                    pa.array(n[path]),
                ],
                names=["doc_key", "uid", "start", "anchor", "edge", "n"],
            )


def joined(b: Block, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    start, end = b.start[kept], b.end[kept]
    at = np.concatenate([[0], np.cumsum(kept)])[b.word_at]
    size = end - start + 1
    final = np.zeros(len(start), bool)
    final[at[1:][at[1:] > at[:-1]] - 1] = True
    size = size - final
    out_at = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(out_at[-1]) + np.repeat(start - out_at[:-1], size)
    data = np.append(b.data, np.uint8(0x20))[source]
    data[(out_at[1:] - 1)[~final]] = 0x20
    return pa.LargeStringArray.from_buffers(
        b.texts, pa.py_buffer(out_at[at].astype(np.int64)), pa.py_buffer(data)
    ).cast(pa.string())


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the words that no listed edge covers."""
    for batch in batches:
        lists = _Lists(batch.column("spans"), "start", "edges")
        for b in blocks(batch.column("text")):
            row, (start, edges) = lists.rows(b.first, b.first + b.texts)
            change = np.zeros(len(b.hash) + 1, np.int64)
            word = b.word_at[row] + start
            np.add.at(change, word, 1)
            np.add.at(change, word + edges + WINDOW - 1, -1)
            kept = np.cumsum(change)[:-1] == 0
            left = np.diff(np.concatenate([[0], np.cumsum(kept)])[b.word_at])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rest").slice(b.first, b.texts),
                    batch.column("text").slice(b.first, b.texts),
                    pa.array(b.counts),
                    pa.array(b.counts - left),
                    joined(b, kept),
                ],
                names=["rest", "text", "n_words", "n_removed", "kept_text"],
            )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, ...) as rest, text, n_words, n_removed and kept_text.

    ``rest`` holds the other columns as a struct, whatever their names. Removed is each word
    covered by a window of WINDOW words whose word sequence also starts anywhere else, the same
    document included. ``kept_text`` joins the other words by one space. A null or empty text has
    no words. Rows that repeat another row repeat its words, and so do rows without a doc_id.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    text = F.col("text").cast("string")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_key"),
        F.xxhash64("doc_id", text).alias("uid"),
        text.alias("text"),
        F.struct(*rest).alias("rest"),
    )
    paths = keyed.select("doc_key", "uid", "text").mapInArrow(_paths, _PATH)
    common = (
        paths.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.max("again").alias("again"))
        .filter("n > 1 or again")
        .select("anchor")
    )
    near = store(paths.join(common, "anchor"), "paths")

    same = ["anchor", "path_a", "path_b", "edges"]
    kinds = near.groupBy(*same).agg(
        F.count("*").alias("n"),
        F.max("again").alias("again"),
        F.min(F.struct("doc_key", "uid", "start")).alias("one"),
    )
    kinds = store(kinds, "kinds")
    whole = near.join(kinds.filter("n > 1").select(*same), same).select("doc_key", "uid", "start", "edges")

    branching = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("anchor")
    opened = (
        kinds.join(branching.withColumn("branches", F.lit(True)), "anchor", "left")
        .filter("branches or (again and n = 1)")
        .groupBy("one.doc_key", "one.uid")
        .agg(F.collect_list(F.struct("one.start", "edges", "anchor", "n")).alias("paths"))
    )
    # One exchange of the texts serves both joins.
    texts = keyed.repartition(parts, "doc_key", "uid")
    edges = texts.join(opened, ["doc_key", "uid"]).mapInArrow(
        _opened, "doc_key long, uid long, start int, anchor long, edge long, n long"
    )
    again = edges.groupBy("anchor", "edge").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor", "edge")
    single = (
        edges.filter("n = 1")
        .join(again, ["anchor", "edge"])
        .select("doc_key", "uid", "start", F.lit(1).alias("edges"))
    )
    spans = (
        whole.union(single)
        .distinct()
        .groupBy("doc_key", "uid")
        .agg(F.collect_list(F.struct("start", "edges")).alias("spans"))
    )
    counts = [StructField("n_words", LongType()), StructField("n_removed", LongType())]
    kind = StructType([*texts.select("rest", "text").schema, *counts, StructField("kept_text", StringType())])
    return (
        texts.join(spans, ["doc_key", "uid"], "left")
        .select("rest", "text", "spans")
        .mapInArrow(_without, kind)
    )
