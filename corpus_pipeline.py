"""A training-data pipeline of five corpus operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and gives the columns of ``documents`` to the next one; the last gives packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import mixing, ngram_join, packing, quality_rules, suffix_dedup
from roadpulse.llm.common import discard, materialize, read
from roadpulse.llm.queries import vocabulary_path


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule; null and empty texts go."""
    return quality_rules.quality_filter(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; repeated rows of it are one row then."""
    kept = ngram_join.similarity_join(docs, with_key=True).filter("kept").select(F.col("doc_id").alias("__rp_kept"), F.col("text_key").alias("__rp_kept_key")).distinct()
    # by id and text: rows with a null or shared id are decided on one by one
    keyed = docs.withColumn("__rp_key", ngram_join.text_key(F.col("text")))
    stay = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["__rp_kept"]) & (keyed["__rp_key"] == kept["__rp_kept_key"]), "left_semi")
    return stay.dropDuplicates(["doc_id", "__rp_key"]).drop("__rp_key")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that documents with smaller ids have too; a document of which nothing is left goes."""
    return suffix_dedup.cut_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the budgets of the source tree; a document drawn for two epochs is there twice."""
    return mixing.mix_sources(docs, epoch_col="__rp_epoch").drop("__rp_epoch")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_passages),
    ("mixing sources to target weights", mix_to_weights),
    ("packing", pack_sequences),
]

#: SQL can't express the tokens or the plan of the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
        if stored is not None:
            discard(stored)
        stored = docs
    return STAGES[-1][1](spark, docs, sf_dir)
