"""Toxic documents by a chain of linear classifiers over toxicity categories.

Categories are predicted one after the other. Each model sees which marked word beginnings a
document has and, of the categories before, the probabilities. So that a model learns from
probabilities as uncertain as those it will meet, training uses out-of-fold ones: a row's come
from models that were fitted without the row's fold.

Models are fitted on a bounded sample of labelled rows, ``MOST_PER_CLASS`` with and as many times
``CLEAN_PER_TOXIC`` without the last label, smallest hash of the id first. Marked beginnings are
chosen by the likelihood ratio of their document counts in the sample, and every document is
scored over its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.linear import fit_logistic, sigmoid
from llm.words import Block, blocks, byte_hashes, mix

MOST_PER_CLASS = 2000
CLEAN_PER_TOXIC = 2
MOST_MARKS = 256
LEAST_RATIO = 16.0  # of the log likelihood, doubled
FOLDS = 4
REJECT = 0.5
BEGINNINGS = (3, 4, 5, 6, 7, 8)  # bytes; the whole word too

# fixed values: English words that tell the categories of documents labelled toxic apart
SEEDS = {
    "insult": ["idiot", "moron", "loser", "clown", "stupid"],
    "contempt": ["scum", "trash", "worthless", "pathetic", "disgusting"],
}
CATEGORIES = (*SEEDS, "toxic")


def marks(b: Block) -> list[np.ndarray]:
    """Hashes of the words of a block and of their beginnings, one array per kind; 0 where too short."""
    size = b.end - b.start
    out = [b.hash]
    for n in BEGINNINGS:
        long = size > n
        h = np.zeros(len(size), np.uint64)
        h[long] = byte_hashes(b.data, b.start[long], b.start[long] + n)
        out.append(h)
    return out


def text_counts(batches):
    """Per batch (text, label): each mark with the number of texts that have it, without and with the label."""
    for batch in batches:
        label = np.asarray(batch.column("label"))
        found, seen = [], []
        for b in blocks(batch.column("text"), lower=True):
            row = np.repeat(np.arange(b.texts), b.counts)
            salt = mix(np.arange(b.texts, dtype=np.uint64))
            for h in marks(b):
                _, once = np.unique(h ^ salt[row], return_index=True)  # distinct pairs of text and mark
                once = once[h[once] != 0]
                found.append(h[once])
                seen.append(label[b.first + row[once]])
        if not found:
            continue
        kinds, at = np.unique(np.concatenate(found), return_inverse=True)
        label = np.concatenate(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kinds.view(np.int64)),
                pa.array(np.bincount(at, label == 0, len(kinds)).astype(np.int64)),
                pa.array(np.bincount(at, label == 1, len(kinds)).astype(np.int64)),
            ],
            names=["mark", "without", "with"],
        )


def present(column: pa.Array, chosen: np.ndarray) -> np.ndarray:
    """Rows: texts; columns: whether each chosen mark (sorted) occurs in the text."""
    out = np.zeros((len(column), len(chosen)), bool)
    if not len(chosen):
        return out
    maybe = np.zeros(1 << 16, bool)
    maybe[chosen & np.uint64(0xFFFF)] = True
    for b in blocks(column, lower=True):
        row = np.repeat(np.arange(b.texts) + b.first, b.counts)
        for h in marks(b):
            near = np.flatnonzero(maybe[h & np.uint64(0xFFFF)])
            place = np.minimum(np.searchsorted(chosen, h[near]), len(chosen) - 1)
            hit = chosen[place] == h[near]
            out[row[near[hit]], place[hit]] = True
    return out


@dataclass
class Chain:
    """Marks in order, and each category's weights: bias, marks, earlier probabilities."""

    categories: tuple[str, ...]
    chosen: np.ndarray
    weights: list[np.ndarray]

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        x = np.hstack([np.ones((len(found), 1)), found])
        for w in self.weights:
            x = np.hstack([x, sigmoid(x @ w)[:, None]])
        return x[:, 1 + found.shape[1] :]


def fit_category(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of one category, which never occurs if no row has it."""
    if y.any():
        return fit_logistic(x, y, free=1)
    return np.concatenate([[-20.0], np.zeros(x.shape[1] - 1)])


def fit_chain(found: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> list[np.ndarray]:
    """Weights per category, in the order of the columns of labels."""
    x, out = np.hstack([np.ones((len(found), 1)), found]), []
    for y in labels.T.astype(float):
        apart = np.zeros(len(y))
        for k in range(FOLDS):
            own = fold == k
            if own.any():
                apart[own] = sigmoid(x[own] @ fit_category(x[~own], y[~own]))
        out.append(fit_category(x, y))
        x = np.hstack([x, apart[:, None]])
    return out


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label): a bounded number of labelled rows, chosen by the hash of the id."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    order = F.xxhash64("doc_id")
    few = [
        known.filter(F.col("label") == y).orderBy(order, "doc_id").limit(n)
        for y, n in ((1, MOST_PER_CLASS), (0, MOST_PER_CLASS * CLEAN_PER_TOXIC))
    ]
    # At most MOST_PER_CLASS * (1 + CLEAN_PER_TOXIC) rows of two numbers: the bound of the broadcast.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(few[0].union(few[1])), "doc_id"
    )


def train(docs: DataFrame, labels: DataFrame) -> Chain:
    """A chain fitted on labels (doc_id, toxic, ...); without any positive label it accepts all."""
    sample = training_sample(docs, labels).select("doc_id", "text", F.col("label").cast("int").alias("label"))
    sample = sample.repartition(docs.sparkSession.sparkContext.defaultParallelism).cache()
    try:
        totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        clean, toxic = totals.get(0, 0), totals.get(1, 0)

        def part(n, of, rate):
            return F.when(n > 0, n * F.log(n / (F.lit(max(of, 1)) * rate))).otherwise(0.0)

        a, b = F.col("without"), F.col("with")
        counts = (
            sample.select("text", "label")
            .mapInArrow(text_counts, "mark long, without long, with long")
            .groupBy("mark")
            .agg(F.sum("without").alias("without"), F.sum("with").alias("with"))
        )
        rate = (a + b) / F.lit(max(clean + toxic, 1))
        ratio = 2 * (
            part(a, clean, rate) + part(b, toxic, rate)
            + part(clean - a, clean, 1 - rate) + part(toxic - b, toxic, 1 - rate)
        )
        best = counts.withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO)
        rows = best.orderBy(F.desc(F.round("ratio", 6)), "mark").limit(MOST_MARKS).collect()
        chosen = np.sort(np.array([r["mark"] for r in rows], np.int64).view(np.uint64))

        @F.arrow_udf("array<int>")
        def found_marks(text: pa.Array) -> pa.Array:
            return pa.array([np.flatnonzero(x) for x in present(text, chosen)], pa.list_(pa.int32()))

        seeded = [
            F.lower("text").rlike("|".join(words)).cast("int").alias(name) for name, words in SEEDS.items()
        ]
        few = (
            sample.select("doc_id", "label", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold"), *seeded, found_marks("text").alias("found"))
            .orderBy("doc_id", F.xxhash64("text"))
            .collect()
        )
    finally:
        sample.unpersist()
    found = np.zeros((len(few), len(chosen)), bool)
    for i, r in enumerate(few):
        found[i, r["found"]] = True
    toxic = np.array([r["label"] for r in few], int)
    labels_of = np.array([[r[c] * r["label"] for c in SEEDS] for r in few], int).reshape(len(few), len(SEEDS))
    weights = fit_chain(found, np.column_stack([labels_of, toxic]), np.array([r["fold"] for r in few], int))
    return Chain(CATEGORIES, chosen, weights)


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of docs as a struct ``row``, with p_<category> and toxic.

    A null or empty text has no marks. Other columns keep any name, inside the struct.
    """
    kind = pa.struct([(f"p_{c}", pa.float64()) for c in chain.categories])

    @F.arrow_udf(", ".join(f"p_{c} double" for c in chain.categories))
    def probabilities(text: pa.Array) -> pa.Array:
        p = chain.probabilities(present(text, chain.chosen))
        return pa.StructArray.from_arrays([pa.array(c) for c in p.T.copy()], fields=list(kind))

    rows = docs.select(F.struct("*").alias("row"), probabilities(F.col("text").cast("string")).alias("p"))
    return rows.select("row", "p.*", (F.col(f"p.p_{chain.categories[-1]}") >= REJECT).alias("toxic"))
