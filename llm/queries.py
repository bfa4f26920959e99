"""Queries of the training-data operators over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import alignment, chat, debruijn, hilbert, licences, merkle, minhash, mixing, ngrams, packing, quality, spotsigs, toxicity
from llm.tables import shipped

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every fiftieth one. Null, zero and non-finite vectors and rows without an id take no part;
    equal scores go to smaller ids, repeats of a row are found once; an empty table gives none."""
    return hilbert.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of whole documents. Null and empty texts have an empty set and link with nothing; rows that share an id
    are one document with its links; ties go to the smallest id; an empty table gives none."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix takes of every document. Null and empty texts have size 0 and rows that repeat an id draw alike; a null
    source is the last one; an empty table gives none. Texts of any length are only counted."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("row.doc_id", "size", "source_size", "target", taken)


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in whole documents, unknown licences included. Null and empty texts have none; repeated rows give
    theirs again; rows without an id give theirs with none; an empty table gives none."""
    docs = _table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of whole texts and of their edited ones. A null text is empty; rows that share an id follow by a hash
    of their text, rows without one come last; an empty table gives none."""
    return spotsigs.fingerprints(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids in sequences. A null or empty text is its end alone; repeated rows, with or without an id, are
    packed each for itself; an empty table gives none. Long texts are cut into pieces."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words without passages that occur again. A null or empty text has no words; repeated rows repeat each other's
    words, with or without an id; an empty table gives none."""
    rows = debruijn.remove_repeats(_table(spark, sf_dir, "documents"))
    return rows.select("rest.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in one format, read back. A null text or role is empty; rows of equal turn stand by role and text;
    an empty table gives the planted conversation alone."""
    row = lambda turn, role: (F.lit(chat.TRICKY_ID).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"),
                              F.lit(role).alias("role"), F.lit(chat.TRICKY_TEXT).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    for turn, role in enumerate(("user", "assistant")):
        turns = turns.union(spark.range(0, 1, 1, 1).select(*row(turn, role)))
    return chat.digests(chat.format_conversations(turns))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of whole texts. Null and empty texts have a score too; rows without an id are never held out, and
    repeated rows score alike; without labels all score 0.5 or less; an empty table gives none."""
    docs = _table(spark, sf_dir, "documents")
    rows = quality.scored(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return rows.select("row.doc_id", "held_out", "score", "predicted")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity chances of whole texts. Null and empty texts hold no mark; repeated rows score alike; without toxic
    labels nothing is toxic; an empty table gives none."""
    docs = _table(spark, sf_dir, "documents")
    rows = toxicity.scored(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return rows.select("row.doc_id", *(f"p_{c}" for c in toxicity.CATEGORIES), "toxic")


def op11_ngram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of whole texts, learned from those not held out. A null or empty text is its end alone; a row
    without an id is learned from; repeated rows count and score each for itself; an empty table gives none."""
    docs, learned = _table(spark, sf_dir, "documents"), ~ngrams.held_out()
    rows = ngrams.score(docs, ngrams.train(docs.filter(learned)), learned)
    return rows.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and checked proofs of all rows. Nulls are values; a null language is one, the first; repeated rows are
    leaves of their own; rows that tie stand by leaf; an empty table gives none."""
    docs = _table(spark, sf_dir, "documents")
    return merkle.checked(merkle.manifest(docs, merkle.planted_tampering()))


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token alignment of whole texts. Null and empty texts, and those that a tokenizer spells otherwise, have zeros;
    repeated rows count each for itself, with or without an id; an empty table gives none."""
    return alignment.align(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: shipped(q)
    for q in (
        op1_hilbert_neighbours,
        op2_minhash_dedup,
        op3_mixing,
        op4_licences,
        op5_spotsigs,
        op6_packing,
        op7_substring_dedup,
        op8_chat_format,
        op9_quality,
        op10_toxicity,
        op11_ngram_filter,
        op12_merkle_manifest,
        op13_cross_tokenizer,
    )
}
SQL: dict[str, str] = {"op3_mixing": mixing.SQL, "op8_chat_format": chat.SQL, "op12_merkle_manifest": merkle.SQL}
