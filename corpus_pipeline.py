"""The corpus pipeline: toxicity, quality, near-duplicates, mixing, packing.

Each stage takes what the one before it kept, whole rows of ``documents``, and its decisions take
effect: rejected documents go, one document of each near-duplicate class stays, the mix repeats
or leaves out documents, and the last stage returns the packed pieces.  ``run`` writes every
stage's rows to the shared checkpoint folder and reads them back, so a lost executor costs the
stage at hand at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import bagminhash, mixing, packing, quality_mil, toxicity
from courtside.llm.common import remainder, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject."""
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"), docs.columns,
                                      remainder(F.col("doc_id"), 5) != 0)
    return scored.where("predicted = 0").select("doc.*")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = quality_mil.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 3) != 1)
    return quality_mil.score_documents(docs, model, docs.columns).where("predicted = 1").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return bagminhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in their training sequences."""
    return packing.with_digest(packing.pack(docs, packing.default_tokenizer()))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# Learned scores, Poisson signatures and tokenisation are no SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
