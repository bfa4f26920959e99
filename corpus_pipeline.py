"""A corpus pipeline: toxicity, near-dedup, substring dedup, mixing, packing.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of docs, whatever
else these hold. A table without rows gives one without rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import debruijn, minhash, mixing, packing, toxicity
from llm.tables import shipped, store


@shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the table of labels, doesn't reject.

    Null and empty texts hold no mark and stay; repeated rows are judged alike, with or without an id; texts of any
    length are read whole. Without toxic labels all rows stay.
    """
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, chain).filter(~F.col("toxic")).select("row.*")


@shipped
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; of rows that share it, one by text hash.

    Rows without an id stay. Null and empty texts are near to nothing.
    """
    kept = minhash.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    one = F.min_by(F.struct("*"), F.coalesce(F.xxhash64("text"), F.lit(0))).alias("row")
    with_id = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(one).select("row.*")
    return with_id.select(docs.columns).unionByName(docs.filter("doc_id is null"))


@shipped
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; those with repeated passages keep their other words, joined by one space.

    Null and empty texts stay as they are. Rows that repeat each other lose the words that both hold in a passage.
    """
    cut = F.col("n_removed") > 0
    rows = debruijn.remove_repeats(docs)
    changed = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.char_length("kept_text")).otherwise(F.col("rest.n_chars")).cast(kind)
    return rows.select(*(changed.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))


@shipped
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for.

    Rows that repeat an id draw alike; rows without one draw by their text. A null source is a source. Null and empty
    texts have no words and are taken at the source's rate.
    """
    return mixing.repeated(mixing.mix(docs))


@shipped
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their sequences.

    A null or empty text is its end alone. Repeated rows, with or without an id, are packed each for itself.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Trained classifiers, approximate candidates and a tokenizer: SQL can't express these.
ORACLE_SQL = None


@shipped
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
