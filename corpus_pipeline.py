"""The corpus pipeline: quality, near duplicates, benchmark leaks, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stocklens.llm import decontamination, pii, quality_classifier, sentencepiece_bpe, simhash
from stocklens.llm.common import ship, stored, table

#: No SQL form: trained models, XXH64 votes and merges by rank. Tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    ship(spark)
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, the one with the smallest id."""
    ship(spark)
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    ship(spark)
    return decontamination.without_passages(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    ship(spark)
    return pii.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip."""
    ship(spark)
    return sentencepiece_bpe.encoded(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number + 1}")
    return docs
