"""Quality of documents by pairwise ranking.

A Bradley-Terry model says that a document of label 1 beats one of label 0 with a probability
that is logistic in the difference of their scores. Scores are linear in features of the text, so
the model is a logistic regression on feature differences of preference pairs, without a bias.
Documents are then told apart at the quantile of the scores that the share of label 0 names.

The model is fitted on all labelled rows that aren't held out: each of the more frequent label is
paired with TURNS of the other, which take turns, so that all have a part. Newton's sums, the means
and the quantile are computed over all of them, by Spark. Every document is scored over its whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from llm.linear import fit_logistic, newton, sigmoid, slope_and_curve
from llm.tables import shuffle_partitions, store
from llm.words import WORD_POWERS, Block, blocks

TURNS = 4
PAIRS = 20000  # of a fit in memory
RIDGE = 5.0 / PAIRS  # per pair
PARTS = 1 << 10  # of a label's rows, to number them
BINS = MOST_VALUES = 1 << 12  # of a histogram of scores, and of scores that the driver takes
MOST_SHARED = 1 << 12  # rows of a label that are broadcast; of more, none meets many
GOOD = 0.7  # score from which on a document is predicted to be good
HELD_OUT = 2  # remainder of the id's checksum by FOLDS that is never learned from
FOLDS = 4

_LETTER, _UPPER, _DIGIT, _SYMBOL, _STOP = (np.zeros(256, bool) for _ in range(5))
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER[0x41:0x5B] = True
_DIGIT[0x30:0x3A] = True
_SYMBOL[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in ".,'-"]] = True
_STOP[[ord(c) for c in ".?!"]] = True

FEATURES = (
    "log_words", "letters", "upper", "digits", "symbols", "symbol_words", "wordless", "word_length", "long_words",
    "short_words", "stops", "lines", "variety", "adjacent", "repeated_runs", "capitalised",
)


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0.0], np.cumsum(values, dtype=float)])[at])


def _repeats(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distinct values of each text."""
    return np.array([len(np.unique(values[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)], float)


def features(b: Block) -> np.ndarray:
    """One row per text; an empty text has zeros only."""
    n, size = b.counts.astype(float), np.diff(b.text_at).astype(float)
    words, chars = np.maximum(n, 1), np.maximum(size, 1)
    length = (b.end - b.start).astype(float)
    sums = {k: np.concatenate([[0], np.cumsum(t[b.data])]) for k, t in (("letter", _LETTER), ("symbol", _SYMBOL))}
    in_word = {k: s[b.end] - s[b.start] for k, s in sums.items()}
    same = np.zeros(len(b.hash), bool)
    same[1:] = b.hash[1:] == b.hash[:-1]
    same[b.word_at[:-1][b.word_at[:-1] < len(same)]] = False
    run, run_at = b.windows(3)
    runs = WORD_POWERS.spans(b.hash, run, run + 3)
    number = np.maximum(np.diff(run_at), 1)
    byte = lambda table: _per_text(table[b.data], b.text_at)
    word = lambda values: _per_text(values, b.word_at) / words
    first = b.data[b.start] if len(b.start) else b.data[:0]
    return np.column_stack(
        [
            np.log1p(n),
            byte(_LETTER) / chars,
            byte(_UPPER) / chars,
            byte(_DIGIT) / chars,
            byte(_SYMBOL) / chars,
            word(in_word["symbol"] > 0),
            word(in_word["letter"] == 0),
            word(length) / 10,
            word(length > 15),
            word(length < 4),
            byte(_STOP) / words,
            _per_text(b.data == 0x0A, b.text_at) / words,
            np.log1p(_repeats(b.hash, b.word_at)) / np.maximum(np.log1p(n), 1),
            word(same),
            1 - (_repeats(runs, run_at) / number) * (np.diff(run_at) > 0),
            word(_UPPER[first]),
        ]
    )


def table(column: pa.Array) -> np.ndarray:
    rows = [features(b) for b in blocks(column)]
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


def held_out() -> Column:
    """Whether a row's id keeps it out of training; a row without an id isn't held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expanded(x, self.mean, self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, GOOD at the threshold."""
        return sigmoid(self.raw(x) - self.threshold + np.log(GOOD / (1 - GOOD)))


def expanded(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, bounded, and their squares: both too little and too much can be bad."""
    z = np.clip((x - mean) / scale, -4, 4)
    return np.hstack([z, z * z])


def fit(x: np.ndarray, good: np.ndarray, share_bad: float) -> Ranker:
    """A ranker from features and labels; ``share_bad`` of all documents are to fall below its threshold."""
    mean, scale = x.mean(0) if len(x) else np.zeros(len(FEATURES)), x.std(0) + 1e-6 if len(x) else np.ones(len(FEATURES))
    z, ones, zeros = expanded(x, mean, scale), np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(ones) or not len(zeros):
        return Ranker(mean, scale, np.zeros(2 * len(FEATURES)), -1.0 if len(ones) else 1.0)
    random = np.random.default_rng(9)
    better, worse = random.choice(ones, PAIRS), random.choice(zeros, PAIRS)
    # a preference and its mirror image, so that neither outcome is missing
    apart = z[better] - z[worse]
    apart[1::2] *= -1
    weights = fit_logistic(apart, 1.0 - np.arange(PAIRS) % 2, ridge=RIDGE * PAIRS)
    raw = z @ weights
    weight = np.where(good == 1, (1 - share_bad) / len(ones), share_bad / len(zeros))
    order = np.argsort(raw, kind="stable")
    below = int(np.searchsorted(np.cumsum(weight[order]), share_bad - 1e-12))
    around = raw[order[[below, min(below + 1, len(raw) - 1)]]]
    return Ranker(mean, scale, weights, float(around.mean()))


def _sums(rows: DataFrame, parts: Callable[..., list[np.ndarray]], *columns: str) -> list[np.ndarray]:
    """What ``parts`` gives for array columns (rows as matrices), summed over all rows: a short row from every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = [np.asarray(batch.column(c).flatten()).reshape(batch.num_rows, -1) for c in columns]
                own = parts(*x)
                total = own if total is None else [t + o for t, o in zip(total, own, strict=True)]
        if total is not None:
            flat = np.concatenate([np.ravel(t) for t in total])
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([flat], pa.list_(pa.float64()))], names=["number", "flat"])

    found = sorted(rows.select(*columns).mapInArrow(run, "number long, flat array<double>").collect())
    shapes = [np.shape(t) for t in parts(*(np.zeros((1, len(FEATURES))) for _ in columns))]
    flat = np.sum([r["flat"] for r in found], axis=0)
    ends = np.cumsum([int(np.prod(x)) for x in shapes])
    return [t.reshape(x) for t, x in zip(np.split(flat, ends[:-1]), shapes, strict=True)]


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, quality, x) with ``place``, their number among those of their label, from 0."""
    mark = F.xxhash64("doc_id", "x")
    parted = rows.withColumn("mark", mark).withColumn("part", F.pmod("mark", F.lit(PARTS)))
    before = Window.partitionBy("quality").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parted.groupBy("quality", "part").count().select("quality", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    within = F.row_number().over(Window.partitionBy("quality", "part").orderBy("mark", "doc_id", "x"))
    # At most 2 * PARTS rows of three numbers: the bound of the broadcast.
    placed = parted.withColumn("within", within).join(F.broadcast(shifts), ["quality", "part"])
    return placed.select("quality", "x", (F.col("within") - 1 + F.col("shift")).alias("place"))


def _pairs(rows: DataFrame, number: dict[int, int]) -> DataFrame:
    """(good, bad): features of preference pairs. All rows have a part, those of a label about equally often."""
    few, many = sorted(number, key=lambda y: (number[y], y))
    n = number[few]
    turns = rows.filter(F.col("quality") == many).select("place", F.col("x").alias("many"), F.explode(F.sequence(F.lit(0), F.lit(TURNS - 1))).alias("turn"))
    turns = turns.withColumn("partner", (F.col("place") + F.col("turn") * max(n // TURNS, 1)) % n)
    other = rows.filter(F.col("quality") == few).select(F.col("place").alias("partner"), F.col("x").alias("few"))
    pairs = turns.join(F.broadcast(other) if n <= MOST_SHARED else other, "partner")
    dealt = pairs.repartition(shuffle_partitions(rows.sparkSession), "place", "turn").sortWithinPartitions("place", "turn")
    return dealt.select(*(F.col("few" if y == few else "many").alias(name) for y, name in ((1, "good"), (0, "bad"))))


def _quantile(raw: DataFrame, weight: dict[int, float], share: float) -> float:
    """Halfway between the smallest value of raw (quality, raw) up to which rows weigh ``share`` and the next larger one.

    Histograms narrow down to few values, or to one.
    """
    low, high = raw.agg(F.min("raw"), F.max("raw")).first()
    below = 0.0
    while low < high:
        values = raw.filter(F.col("raw").between(low, high))
        place = F.least(F.floor((F.col("raw") - low) / (high - low) * BINS), F.lit(BINS - 1)).alias("bin")
        ones = F.sum("quality").alias("ones")
        bins = values.groupBy(place).agg(F.count("*").alias("n"), ones, F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("bin").collect()
        for b in bins:
            own = b["ones"] * weight[1] + (b["n"] - b["ones"]) * weight[0]
            if below + own >= share - 1e-12 or b is bins[-1]:
                break
            below += own
        low, high = b["low"], b["high"]
        if b["n"] <= MOST_VALUES and low < high:
            for r in raw.filter(F.col("raw").between(low, high)).orderBy("raw").collect():
                low = high = r["raw"]
                below += weight[r["quality"]]
                if below >= share - 1e-12:
                    break
    after = raw.filter(F.col("raw") > low).agg(F.min("raw")).first()[0]
    return low if after is None else (low + after) / 2


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    """A ranker from labels (doc_id, quality, ...) of the rows that aren't held out."""
    known = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}

    @F.arrow_udf("array<double>")
    def described(text: pa.Array) -> pa.Array:
        return pa.array(list(table(text)), pa.list_(pa.float64()))

    # Features are a few numbers, so texts aren't shuffled.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    each = texts.filter("doc_id is not null").filter(~held_out()).select("doc_id", described("text").alias("x"))
    # Stored before they are numbered: numbering reads them twice.
    rows = store(_numbered(store(each.join(known, "doc_id"), "described")), "features")
    number = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    n, zero = sum(number.values()), np.zeros(len(FEATURES))
    mean = _sums(rows, lambda x: [x.sum(0)], "x")[0] / n if n else zero
    scale = (np.sqrt(_sums(rows, lambda x: [((x - mean) ** 2).sum(0)], "x")[0] / n) if n else zero + 1) + 1e-6 * bool(n)
    if len(number) < 2:
        return Ranker(mean, scale, np.zeros(2 * len(FEATURES)), -1.0 if 1 in number else 1.0)

    pairs = _pairs(rows, number).persist(StorageLevel.MEMORY_AND_DISK)
    try:

        def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            def part(good: np.ndarray, bad: np.ndarray) -> list[np.ndarray]:
                return list(slope_and_curve(expanded(good, mean, scale) - expanded(bad, mean, scale), np.ones(len(good)), w))

            slope, curve = _sums(pairs, part, "good", "bad")
            return slope, curve

        weights = newton(sums, np.full(2 * len(FEATURES), RIDGE * TURNS * max(number.values())))
    finally:
        pairs.unpersist()

    @F.arrow_udf("double")
    def raw(x: pa.Array) -> pa.Array:
        return pa.array(expanded(np.asarray(x.flatten()).reshape(len(x), -1), mean, scale) @ weights)

    bad = totals[0] / sum(totals.values())
    weight = {1: (1 - bad) / number[1], 0: bad / number[0]}
    return Ranker(mean, scale, weights, _quantile(store(rows.select("quality", raw("x").alias("raw")), "raw"), weight, bad))


def scored(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """The rows of docs as a struct ``row``, with held_out, score and predicted.

    Nothing but the text counts for a score; a null text is empty. Other columns keep any name,
    inside the struct.
    """

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(ranker.scores(table(text)))

    rows = docs.select(F.struct("*").alias("row"), held_out().alias("held_out"), score(F.col("text").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
