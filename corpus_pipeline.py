"""The corpus pipeline: documents through the operators of ``quotemill.llm``, one stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import language_id, mixing, near_dedup, packing
from quotemill.llm.common import word_count
from quotemill.session import stage_path

#: A document goes if less than this part of its n-grams is in any one language (less, where the language's own have less), ...
LEAST_SCORE = 0.25
#: ... unless it has so few that they say little.
FEW_NGRAMS = 20


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents in a language that the labelled ones teach; those it rejects go.

    Half the score that nearly all labelled documents of a language reach by what the others of it
    teach is enough, if it is below LEAST_SCORE; any n-gram will do where they reach nothing.
    """
    sample = language_id.draw(docs)
    filters, others = language_id.fit(sample)
    named = language_id.predict(docs, filters)
    least = F.lit(LEAST_SCORE)
    if own := language_id.reached(sample, others, FEW_NGRAMS):
        least = F.create_map(*[F.lit(x) for k, v in own.items() for x in (k, min(LEAST_SCORE, v / 2))])[F.col("lang_pred")]
    spoken = (F.col("score") > 0) & (F.col("score") >= least) | (F.col("ngrams") < FEW_NGRAMS)
    return named.where((F.col("lang_pred") != language_id.UNKNOWN) & spoken).select("record.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group that shares 8 in 10 of its 5-word shingles."""
    return near_dedup.one_of_each(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: what the mix takes of each document, a row for each time it does."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every text with its length bucket, batch and slot."""
    rows = docs.select("doc_id", "source", "text", word_count(F.col("text")).alias("length"))
    return packing.pack(rows, "length", ["doc_id"], ties=["text"])


STAGES = [
    ("language_id", known_language),
    ("near_dedup", without_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Stages draw by seeded hashes and learn a model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = stage_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
